import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import brute
from daybridge.llm import lm
from daybridge.llm.lm import lm_scores, train
from daybridge.llm.queries import QUERIES


def _close(a, b):
    return abs(a - b) <= 1e-9 * max(1.0, abs(a), abs(b))


def _discounts(counts):
    n = [sum(1 for c in counts if c == k) for k in range(5)]
    if not (n[1] and n[2] and n[3]):
        return [0, 0.5, 1, 1.5]
    y = n[1] / (n[1] + 2 * n[2])
    return [0, *(min(max(k - (k + 1) * y * n[k + 1] / n[k], 0), k) for k in (1, 2, 3))]


def _plain(train, texts):
    """log10 probabilities by the interpolated modified Kneser-Ney trigram model; and its conditional probability."""
    tokens = [["\n", *brute.spaced(t), "\n"] for t in train]
    triples = Counter(x for t in tokens for x in zip(t, t[1:], t[2:]))
    pairs = Counter(p for t in tokens for p in zip(t, t[1:]) if p[0] == "\n")
    pairs.update((v, w) for _, v, w in triples if v != "\n")
    ones = Counter(w for _, w in pairs)
    types, total = len({w for t in tokens for w in t[1:]}), len(pairs)
    d3, d2, d1 = (_discounts(c.values()) for c in (triples, pairs, ones))

    def contexts(counts):
        size, left, off = Counter(), defaultdict(float), _discounts(counts.values())
        for x, c in counts.items():
            size[x[:-1]] += c
            left[x[:-1]] += off[min(c, 3)]
        return size, left

    (size3, left3), (size2, left2) = contexts(triples), contexts(pairs)
    spare = sum(d1[min(c, 3)] for c in ones.values()) / total

    def chance(u, v, w):
        p = max(ones[w] - d1[min(ones[w], 3)], 0) / total + spare / (types + 1)
        if size2[v,]:
            c = pairs[v, w]
            p = max(c - d2[min(c, 3)], 0) / size2[v,] + left2[v,] / size2[v,] * p
        if u is not None and size3[u, v]:
            c = triples[u, v, w]
            p = max(c - d3[min(c, 3)], 0) / size3[u, v] + left3[u, v] / size3[u, v] * p
        return p

    found = []
    for text in texts:
        t = [None, "\n", *brute.spaced(text), "\n"]
        found.append(sum(math.log10(chance(*x)) for x in zip(t, t[1:], t[2:])))
    return found, chance


def test_against_plain_version(spark, sf, documents):
    found = {r.doc_id: r for r in QUERIES["op1_lm_scoring"](spark, sf).collect()}
    frame, name, _ = lm_scores(documents, documents.where(F.crc32(F.col("doc_id").cast("string")) % 7 != 2), order=2)
    two = {r.doc_id: r[name] for r in frame.collect()}
    rows = documents.collect()
    want, _ = _plain([r.text for r in rows if not found[r.doc_id].held_out], [r.text for r in rows])
    for r, score in zip(rows, want):
        told = found[r.doc_id]
        assert _close(told.score, score)
        assert (told.n_tokens, told.n_known, told.base_score) == (two[r.doc_id].n_tokens, two[r.doc_id].n_known, two[r.doc_id].base)
    held = [r.doc_id for r in rows if found[r.doc_id].held_out]
    assert sum(found[i].score for i in held) > sum(two[i].score for i in held)


def test_probabilities_sum_to_one(documents):
    texts = [r.text for r in documents.limit(20).collect()]
    _, chance = _plain(texts, [])
    words = {w for t in texts for w in [*brute.spaced(t), "\n"]}
    first = brute.spaced(texts[0])
    for u, v in [(None, "\n"), ("\n", first[0]), (first[0], first[1]), ("never", "seen"), ("never", first[1])]:
        assert _close(sum(chance(u, v, w) for w in words) + chance(u, v, "never seen either"), 1.0)


@pytest.mark.parametrize("shards", [1, 7])
def test_hostile(hostile, shards):
    texts = [r.text for r in hostile.collect()]
    found, name, _ = lm_scores(hostile, hostile, order=3)
    got = sorted(r[name].score for r in found.collect())
    assert all(_close(a, b) for a, b in zip(got, sorted(_plain(texts, texts)[0]), strict=True))
    model = train(hostile, shards=shards, order=3)
    scores = [x[3] for x in model.score([(t or "").encode() for t in texts])]
    assert all(_close(a, b) for a, b in zip(scores, _plain(texts, texts)[0], strict=True))


def test_order_tells_contexts_apart(spark):
    """The word after "b" depends on the one before it: a bigram model cannot tell."""
    train_on = spark.createDataFrame([("a b c",), ("x b y",)] * 5, "text string")
    texts = spark.createDataFrame([("a b c",), ("a b y",)], "text string")

    def scores(order):
        found, name, _ = lm_scores(texts, train_on, order=order)
        return {r.text: r[name].score for r in found.collect()}

    assert _close(scores(2)["a b c"], scores(2)["a b y"]) and scores(3)["a b c"] > scores(3)["a b y"] + 0.5


def test_only_empty_texts(spark, empty):
    blank = spark.createDataFrame([("",), (None,), (" ",)], "text string")
    found, name, _ = lm_scores(blank, blank, order=3)
    assert all(_close(r[name].score, s) for r, s in zip(found.collect(), _plain(["", None, " "], ["", None, " "])[0]))
    assert lm_scores(blank, empty, order=3)[2].tokens == 0
    with pytest.raises(ValueError):
        lm_scores(blank, blank, order=4)


@pytest.mark.parametrize("order", [2, 3])
def test_shards_follow_the_text(spark, documents, monkeypatch, order):
    texts = [(r.text or "").encode() for r in documents.limit(50).collect()]
    few = train(documents, order=order)
    size = sum(len((r.text or "").encode()) for r in documents.collect())
    monkeypatch.setattr(lm, "SHARD_TEXT", size // 300)
    many = train(documents, order=order)
    assert len(many.words.sizes) >= 300 > len(few.words.sizes)
    assert all(_close(a[3], b[3]) for a, b in zip(few.score(texts), many.score(texts)))


def test_contexts_of_any_amount(folder):
    """Amounts beyond 16 bits stand beside small ones, and few kinds take a byte each."""
    import numpy as np

    amounts = np.array([[0, 1, 1, 70000, 0, 1 << 40, 65535, 65536], [0, 1, 1, 5, 0, 70000, 1, 2], [0, 0, 0, 1, 0, 2, 65535, 0],
                        [0, 0, 0, 9, 0, 70001, 3, 1]])
    contexts = lm.Contexts(folder, "c", np.array([0, 8]))
    off = [0.0, 0.5, 1.0, 1.5]
    contexts.write(0, amounts, off)
    total, rest = contexts.at(np.arange(8))
    assert total.tolist() == amounts[0].tolist()
    assert rest.tolist() == [float(o @ np.array(off[1:])) / t if t else 1.0 for t, o in zip(amounts[0], amounts[1:].T)]
