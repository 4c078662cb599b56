import random

import duckdb
import numpy as np
import pytest

import brute
from daybridge.llm.decontam import decontaminate, is_contaminated
from daybridge.llm.fmindex import FMIndex, suffix_order
from daybridge.llm.queries import ORACLE, QUERIES


def _text(rng, length, symbols):
    runs = []
    while length > 0:
        run = rng.integers(1, symbols, rng.integers(1, 40))
        runs += [run, [0]]
        length -= len(run)
    return np.concatenate(runs).astype(np.int64)


@pytest.mark.parametrize("symbols", [3, 8, 200])
def test_index_finds_every_occurrence(symbols):
    rng = np.random.default_rng(symbols)
    text = _text(rng, 2000, symbols)
    order = suffix_order(text)
    assert sorted(order.tolist()) == list(range(len(text)))
    index = FMIndex(text, int(symbols).bit_length())
    starts = rng.integers(0, len(text) - 4, 60)
    phrases = np.array([text[a:a + 4] for a in starts if 0 not in text[a:a + 4]] + [[1, 1, 1, 1], [2, 1, 2, 1]])
    low, high = index.ranges(phrases)
    for phrase, a, b in zip(phrases, low, high):
        want = [i for i in range(len(text) - 3) if (text[i:i + 4] == phrase).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def _items(df):
    return [(r.item_id, r.text) for r in df.collect()]


@pytest.mark.parametrize("block_bytes,shard_bytes", [(8 << 20, 8 << 20), (300, 200)])
def test_planted(spark, hostile, block_bytes, shard_bytes):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choices(words, k=n))) for i, n in enumerate([40, 20, 13, 5, 2, 1, 0])]
    items += [(3, "lorem ipsum dolor sit"), (9, None), (None, "sit amet"), (10, "one one " * 10), (11, items[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = [(i, " ".join(rng.choices(words, k=60)) + " " + rng.choice(items[:3])[1].upper()) for i in range(20)]
    docs = spark.createDataFrame([(i, t) for i, t in docs], "doc_id long, text string").unionByName(
        hostile.select("doc_id", "text")).repartition(2)
    found, name = decontaminate(docs, bench, block_bytes=block_bytes, shard_bytes=shard_bytes)
    for r in found.collect():
        x = r[name]
        assert (x.n_words, x.n_hit, x["items"]) == brute.contamination(r.text, items), r
        assert sum(s.past - s.first for s in x.spans) == x.n_hit


def test_columns_stay(hostile, spark):
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    found, name = decontaminate(hostile, bench)
    assert found.columns == [*hostile.columns, name] and name == "_found"
    assert found.where(is_contaminated(name)).count() == 8
    assert found.count() == hostile.count()


def test_empty(spark, empty, hostile):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate(empty, bench)[0].count() == 0
    found, name = decontaminate(hostile, bench)
    assert found.where(f"{name}.n_hit > 0").count() == 0


def test_query_against_sql(spark, sf):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = sorted(con.execute(f"select {','.join(columns)} from ({ORACLE['op10_benchmark_decontamination']})").fetchall())
    got = sorted(tuple(r) for r in QUERIES["op10_benchmark_decontamination"](spark, sf).select(*columns).collect())
    assert got == want and any(r[-1] for r in got)
