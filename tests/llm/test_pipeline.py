import __spark_entry__ as contract
import brute
import corpus_pipeline
from daybridge.llm.langid import learn


def test_registered():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == [*range(1, 14)] and "pipeline" in contract.queries()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "decontamination", "mixing"]


def test_stages_against_brute_force(spark, sf, documents, hostile):
    docs = documents.unionByName(hostile.select("doc_id", "text", "lang", "source").selectExpr(
        "doc_id + 100000 as doc_id", "text", "lang", "source", "cast(length(text) as bigint) as n_chars"))
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    rows = [tuple(r) for r in docs.collect()]

    found = stages["language"](spark, docs, sf)
    assert found.columns == docs.columns
    model = learn(docs)
    rows = [r for r in rows if any(c.isalpha() for c in r[1] or "") and model.predict([r[1].encode()])[1][0] >= corpus_pipeline.LEAST_SHARE]
    assert sorted(map(str, found.collect())) and sorted(tuple(r) for r in found.collect() if r.doc_id) == sorted(r for r in rows if r[0])

    found = stages["exact_dedup"](spark, found, sf)
    best = {}
    for r in rows:
        key = (-len(r[1]), r[0] is None, r[0] or 0)
        best[brute.normalised(r[1])] = min(best.get(brute.normalised(r[1]), (key, r)), (key, r), key=lambda x: x[0])
    rows = [r for _, r in best.values()]
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(rows, key=str)

    found = stages["near_dedup"](spark, found, sf)
    roots = brute.near_components([brute.simhash(r[1]) for r in rows])
    first = {}
    for r, root in zip(rows, roots):
        first[root] = min(first.get(root, r), r, key=lambda x: (x[0] is None, x[0] or 0))
    rows = list(first.values())
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(rows, key=str)

    found = stages["decontamination"](spark, found, sf)
    told = {r: brute.contamination(r[1], bench) for r in rows}
    rows = [r for r, (n, hit, _) in told.items() if not (hit and 20 * hit >= n)]
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(rows, key=str)

    mixed = stages["mixing"](spark, found, sf).collect()
    assert sorted((r.doc_id or -1, r.size) for r in mixed) == sorted((r[0] or -1, len(brute.spaced(r[1]))) for r in rows)


def test_empty(spark, sf, documents):
    docs = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.count() == 0
