import duckdb

from daybridge.llm import linededup
from daybridge.llm.linededup import drop_site_lines
from daybridge.llm.queries import ORACLE, QUERIES


def _brute(rows, ratio, least):
    pages, often = {}, {}
    for host, text in rows:
        pages[host] = pages.get(host, 0) + 1
        for line in {x.strip(" ") for x in (text or "").split("\n")} - {""}:
            often[host, line] = often.get((host, line), 0) + 1
    found = []
    for host, text in rows:
        if text is None:
            found.append((host, None, 0, 0))
            continue
        lines = text.split("\n")
        kept = [x for x in lines if (n := often.get((host, x.strip(" ")), 0)) < least or n <= ratio * pages[host]]
        found.append((host, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(found, key=str)


def test_hostile(spark, hostile, monkeypatch):
    rows = [(h, t) for h in ("x", "y", None) for t in ["menu\nbody %d\n footer " % i for i in range(6)] + [None, "", "\n\n", "menu\nmenu"]]
    rows += [(r.source, r.text) for r in hostile.collect()]
    df = spark.createDataFrame([(i, h, t, "c", "s") for i, (h, t) in enumerate(rows)], "doc_id long, source string, text string, cleaned string, site string")
    for limit in (linededup.BROADCAST_LINES, -1):
        monkeypatch.setattr(linededup, "BROADCAST_LINES", limit)
        found, name = drop_site_lines(df, "source", "text", 0.4, 3)
        assert found.columns == [*df.columns, "_cleaned"]
        got = sorted(((r.source, r[name].text, r[name].n_lines, r[name].n_dropped) for r in found.collect()), key=str)
        assert got == _brute(rows, 0.4, 3)


def test_empty(empty):
    assert drop_site_lines(empty, "source", "text")[0].count() == 0


def test_query_against_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{sf}/documents.parquet')")
    columns = ["doc_id", "source", "n_lines", "n_dropped", "text"]
    want = sorted(con.execute(f"select {','.join(columns)} from ({ORACLE['op4_line_dedup']})").fetchall())
    assert sorted(tuple(r) for r in QUERIES["op4_line_dedup"](spark, sf).select(*columns).collect()) == want
