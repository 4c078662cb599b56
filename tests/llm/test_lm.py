import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from daybridge.llm.lm import lm_scores, scramble, train, unscramble
from daybridge.llm.queries import QUERIES


def _close(a, b):
    return abs(a - b) <= 1e-9 * max(1.0, abs(a), abs(b))


def test_scramble_is_a_bijection():
    x = np.random.default_rng(1).integers(0, 2**64, 10000, dtype=np.uint64)
    assert (unscramble(scramble(x)) == x).all()


def test_against_brute_force(spark, sf, documents):
    import zlib

    rows = documents.collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in rows}
    want, _ = brute.kneser_ney([r.text for r in rows if not held[r.doc_id]], [r.text for r in rows])
    found = {r.doc_id: r for r in QUERIES["op1_lm_scoring"](spark, sf).collect()}
    learned = documents.where(F.crc32(F.col("doc_id").cast("string")) % 7 != 2)
    frame, name, _ = lm_scores(documents, learned, order=2)
    two = {r.doc_id: r[name] for r in frame.collect()}
    tokens = sum(len(brute.spaced(r.text)) + 1 for r in rows if not held[r.doc_id])
    for r, (n, known, base, score) in zip(rows, want):
        x = found[r.doc_id]
        assert (x.held_out, x.n_tokens, x.n_known, x.train_tokens) == (held[r.doc_id], n, known, tokens)
        assert _close(x.base_score, base) and _close(two[r.doc_id].score, score)
    held_out = [x for x in found.values() if x.held_out]
    assert sum(x.score for x in held_out) > sum(x.base_score for x in held_out)


def test_probabilities_sum_to_one(documents):
    texts = [r.text for r in documents.limit(20).collect()]
    _, (unigrams, both) = brute.kneser_ney(texts, [])
    for h in [*list(unigrams)[:5], "\n", "never seen"]:
        assert _close(sum(both(h, w) for w in unigrams) + both(h, "never seen either"), 1.0)


@pytest.mark.parametrize("shards", [1, 7])
def test_hostile(hostile, shards):
    texts = [r.text for r in hostile.collect()]
    found, name, _ = lm_scores(hostile, hostile)
    assert found.columns == [*hostile.columns, name] and name == "_lm"
    want = sorted(brute.kneser_ney(texts, texts)[0])
    got = sorted((r[name].n_tokens, r[name].n_known, r[name].base, r[name].score) for r in found.collect())
    for a, b in zip(got, want, strict=True):
        assert a[:2] == b[:2] and _close(a[2], b[2]) and _close(a[3], b[3])
    assert train(hostile, shards=shards).tokens == sum(len(brute.spaced(t)) + 1 for t in texts)


def test_nothing_to_learn_from(hostile, empty):
    found, name, model = lm_scores(hostile, empty)
    assert model.tokens == 0
    assert all(r[name].score == 0 and r[name].base == 0 and r[name].n_known == 0 for r in found.collect())
    assert lm_scores(empty, empty)[0].count() == 0
    assert math.isclose(found.first()[name].perplexity, 1.0)
