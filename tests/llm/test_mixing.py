import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import brute
from daybridge.llm.mixing import WEIGHTS, mix, numbered, targets
from daybridge.llm.queries import QUERIES


def _check(rows, sizes):
    """rows: (source, size, source_size, target, taken)."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = brute.targets(sizes, {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(names)}, 3)
    taken = dict.fromkeys(sizes, 0)
    for source, size, source_size, target, words in rows:
        assert source_size == sizes[source] and math.isclose(target, want[source], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= words <= 3 * size
        taken[source] += words
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1


def test_whole_table(spark, sf, documents):
    source = {r.doc_id: (r.source, len(brute.spaced(r.text))) for r in documents.collect()}
    sizes = {}
    for s, n in source.values():
        sizes[s] = sizes.get(s, 0) + n
    rows = QUERIES["op9_source_mixing"](spark, sf).collect()
    assert all(r.size == source[r.doc_id][1] for r in rows) and len(rows) == len(source)
    _check([(source[r.doc_id][0], r.size, r.source_size, r.target, r.taken) for r in rows], sizes)
    assert sorted(rows) == sorted(QUERIES["op9_source_mixing"](spark, sf).collect())


def test_hostile(hostile, empty):
    rows = mix(hostile).collect()
    sizes = {}
    for r in hostile.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(brute.spaced(r.text))
    assert sorted((r.source or "", r.size) for r in rows) == sorted(
        (r.source or "", len(brute.spaced(r.text))) for r in hostile.collect())
    _check([(r.source, r.size, r.source_size, r.target, r.taken) for r in rows], sizes)
    assert mix(empty).count() == 0


@pytest.mark.parametrize("sizes", [{"a": 1, "b": 1000, "c": 1}, {"a": 10, "b": 0, "c": 1, "d": 500, None: 3}, {"a": 0}, {"x": 7}])
def test_limits_are_dealt_again(spark, sizes):
    rows = [(i, s, "w " * (n // 2)) for i, (s, n) in enumerate(sizes.items())]
    rows += [(100 + i, s, "w " * (n - n // 2)) for i, (s, n) in enumerate(sizes.items())]
    found = mix(spark.createDataFrame(rows, "doc_id long, source string, text string")).collect()
    _check([(r.source, r.size, r.source_size, r.target, r.taken) for r in found], sizes)


def test_better_documents_come_first(spark):
    rows = [(i, "a", "good words only " * 5 if i % 2 else "1234 ### $$$$ bad " * 4) for i in range(2000)]
    rows += [(5000 + i, "b", "words " * 60) for i in range(500)]
    found = mix(spark.createDataFrame(rows, "doc_id long, source string, text string"), weights=(1, 9)).collect()
    share = {odd: sum(r.taken for r in found if r.source == "a" and r.doc_id % 2 == odd) / sum(
        r.size for r in found if r.source == "a" and r.doc_id % 2 == odd) for odd in (0, 1)}
    assert share[1] > 1.5 * share[0] > 0


def test_source_without_letters(spark):
    rows = [(i, "a", "12 34 " * (i % 7)) for i in range(3000)] + [(i, None, "words " * (i % 5)) for i in range(3000)]
    rows += [(i, "", "some more words") for i in range(500)]
    found = mix(spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(6)).collect()
    sizes = {s: sum(len(r[2].split()) for r in rows if r[1] == s) for s in ("a", "", None)}
    _check([(r.source, r.size, r.source_size, r.target, r.taken) for r in found], sizes)


@given(st.lists(st.integers(0, 60), min_size=1, max_size=25), st.integers(1, 4))
@settings(max_examples=8, deadline=None)
def test_levels_of_many_sources(spark, sizes, epochs):
    sizes = {f"s{i:02}": n * n for i, n in enumerate(sizes)}
    found = targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long").repartition(3), WEIGHTS, epochs)
    want = brute.targets(sizes, {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(sizes)}, epochs)
    assert {r.source: r.target for r in found.collect()} == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_numbered(spark):
    df = spark.range(1000).selectExpr("(id * 7919) % 1000 as v").repartition(5)
    assert all(r.place == r.v for r in numbered(df, "place", df.v).collect())
