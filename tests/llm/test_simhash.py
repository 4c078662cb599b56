import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from daybridge.llm import simhash
from daybridge.llm.components import components
from daybridge.llm.golay import fuzzy_keys
from daybridge.llm.queries import QUERIES
from daybridge.llm.simhash import near_links, simhash_components


def test_fuzzy_keys_shared_up_to_two_bits():
    table = fuzzy_keys(16)
    words = np.arange(1 << 16)
    shown = np.zeros((1 << 16, 4096), bool)
    for column in range(6):
        some = table[:, column] >= 0
        shown[words[some], table[some, column]] = True
    assert set(np.count_nonzero(table >= 0, axis=1)) <= {1, 6}
    sample = np.random.default_rng(1).choice(1 << 16, 3000, replace=False)
    for a in range(16):
        for b in range(a, 16):
            other = sample ^ (1 << a) ^ (1 << b if b > a else 0)
            assert (shown[sample] & shown[other]).any(1).all()


def _expected(rows):
    prints = [brute.simhash(t) for _, t in rows]
    roots = brute.near_components(prints)
    first = {}
    for (i, _), r in zip(rows, roots):
        if i is not None:
            first[r] = min(first.get(r, i), i)
    return sorted(((i, f"{p:016x}", first.get(r)) for (i, _), p, r in zip(rows, prints, roots)), key=str)


def test_against_brute_force(spark, sf, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    found = QUERIES["op5_simhash_near_dedup"](spark, sf).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in found), key=str) == _expected(rows)


def test_hostile(hostile):
    found, placed, place = simhash_components(hostile)
    rows = [(r.doc_id, r.text) for r in hostile.collect()]
    got = sorted(((r.doc_id, f"{r.fingerprint % 2**64:016x}", r.component_id) for r in found.collect()), key=str)
    assert got == _expected(rows)
    assert found.where("kept").count() == len(set(brute.near_components([brute.simhash(t) for _, t in rows])))
    assert set(hostile.columns) < set(placed.columns)


def test_empty(empty):
    assert simhash_components(empty)[0].count() == 0


def _roots(prints, links):
    place = {p: i for i, p in enumerate(prints)}
    found = brute.components(len(prints), [(place[a], place[b]) for a, b in links])
    group = {}
    return [group.setdefault(r, i) for i, r in enumerate(found)]


@pytest.mark.parametrize("distance,crowd", [(3, 8192), (3, 8), (2, 8), (1, 4)])
def test_links_of_dense_groups(spark, monkeypatch, distance, crowd):
    """Thousands of near fingerprints, also in buckets beyond the crowd limit."""
    rng = random.Random(distance * 100 + crowd)
    centres = [rng.getrandbits(64) for _ in range(4)]
    prints = sorted({c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(6))) for c in centres for _ in range(150)})
    df = spark.createDataFrame([(p - (p >> 63 << 64),) for p in prints], "p long").repartition(4)
    links = [(r.a % 2**64, r.b % 2**64) for r in near_links(df, distance, crowd).collect()]
    expected = brute.near_components(prints, distance)
    group = {}
    assert _roots(prints, links) == [group.setdefault(r, i) for i, r in enumerate(expected)]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.root for r in components(df).collect()}
    assert found == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)}
    assert components(df.limit(0)).count() == 0


def test_hot_fingerprint_is_one_node(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("same words here all the time").alias("text"))
    found, _, _ = simhash_components(df)
    assert found.where("component_id = 0").count() == 5000 and found.where("kept").count() == 1
    assert simhash.CROWD > 0
