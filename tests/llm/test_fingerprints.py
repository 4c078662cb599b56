import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from daybridge.llm import fingerprints as fp
from daybridge.llm.queries import QUERIES


def _shingles(text, k=5):
    words = brute.spaced(text)
    return {tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def _plain_print(text, bins=fp.BINS, bits=fp.BITS):
    """Bin by bin with Python integers."""
    least = {}
    for shingle in _shingles(text):
        numbers = [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) for w in shingle]
        hashes = []
        for prime, base in (fp.BIN_HASH, fp.VALUE_HASH):
            value = 0
            for n in numbers:
                value = (value * base + n) % prime
            hashes.append(value)
        least[hashes[0] % bins] = min(hashes[1], least.get(hashes[0] % bins, hashes[1]))
    if not least:
        return b""
    found = []
    for i in range(bins):
        j, power, d = i, 1, 0
        while j not in least:
            if d == fp.DRAWS:
                j = min(least)
                break
            power = power * fp.FACTOR % fp.PRIME
            j, d = (power * (i + 1) + fp.SHIFT * d) % fp.PRIME % bins, d + 1
        found.append(least[j] & (1 << bits) - 1)
    whole = "".join(f"{v:0{bits}b}" for v in found)
    whole += "0" * (-len(whole) % 8)
    return bytes(int(whole[i:i + 8], 2) for i in range(0, len(whole), 8))


TEXTS = ["", " \n", "one", "One", "one two", "a b c d e", "a b c d e f", "größe 日本 x y z w", "word " * 2000,
         " ".join(f"w{i}" for i in range(3000))]


@pytest.mark.parametrize("bins,bits", [(512, 4), (128, 8), (100, 3), (7, 1)])
def test_against_plain_version(documents, bins, bits):
    for text in TEXTS + [r.text for r in documents.limit(15).collect()]:
        assert fp.fingerprint(text.encode(), bins, bits) == _plain_print(text, bins, bits)


def test_pieces_do_not_show(monkeypatch):
    text = " ".join(f"w{i * i % 97}" for i in range(900)).encode()
    whole = fp.fingerprint(text)
    for piece in (1, 5, 64, 1000):
        monkeypatch.setattr(fp, "PIECE", piece)
        assert fp.fingerprint(text) == whole
    monkeypatch.setattr(fp, "REMEMBERED", 3)
    assert fp.fingerprint(text) == whole


@pytest.mark.parametrize("common", [0, 20, 50, 80, 95])
def test_likeness_is_unbiased(common):
    """Over many pairs the mean estimate is the true share of common shingles, for short texts too."""
    rng = np.random.default_rng(common)
    errors = []
    for pair in range(60):
        n = int(rng.choice([30, 200, 1500]))
        a = [f"{pair}.{i}" for i in range(n)]
        b = a[:n * common // 100] + [f"{pair}.b{i}" for i in range(n - n * common // 100)]
        x, y = " ".join(a), " ".join(b)
        true = len(_shingles(x) & _shingles(y)) / len(_shingles(x) | _shingles(y))
        errors.append(fp.likeness(fp.fingerprint(x.encode()), fp.fingerprint(y.encode())) - true)
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.06


def _expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    found = []
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        text, following = text or "", following or ""
        half = len(text) // 2
        new = text[:len(text) - half] + following[:half]
        prints = [fp.fingerprint(t.encode()) for t in (text, new, following)]
        found.append((i, len(text), brute.sha(new), *prints[:2], fp.likeness(*prints[:2]), fp.likeness(prints[0], prints[2])))
    return sorted(found, key=str)


def _rows(frame):
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, bytes(r.fingerprint), bytes(r.edited_fingerprint), r.near_edited, r.near_next)
                   for r in frame.collect()), key=str)


@pytest.mark.parametrize("partitions", [1, 8, 150])
def test_next_document_across_ranges(spark, documents, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert _rows(fp.with_next(documents)[0]) == _expected([(r.doc_id, r.text) for r in documents.collect()])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_hostile(spark, hostile):
    """Repeated and null ids: every row has results, and equal texts equal fingerprints."""
    found, placed, place = fp.with_next(hostile)
    assert found.count() == hostile.count() == placed.count()
    told = found.join(placed.select(*place, "text"), place)
    assert all(bytes(r.fingerprint) == fp.fingerprint((r.text or "").encode()) and r.n_chars == len(r.text or "") for r in told.collect())
    once = spark.createDataFrame([(i, t) for i, t in enumerate(x.text for x in hostile.collect())], "doc_id long, text string")
    assert _rows(fp.with_next(once)[0]) == _expected([tuple(r) for r in once.collect()])


def test_columns(documents):
    pairs = documents.select(fp.fingerprints("text").alias("a"), F.lit(b"").alias("b"))
    for r in pairs.select("a", fp.likenesses("a", "a").alias("same"), fp.likenesses("a", "b").alias("none")).collect():
        assert r.same == 1.0 and r.none == (0.0 if r.a else 1.0)


def test_single_and_empty(spark, empty):
    assert fp.with_next(empty)[0].count() == 0
    one = spark.createDataFrame([(5, "a b c d e f g h")], "doc_id long, text string")
    assert _rows(fp.with_next(one)[0]) == _expected([(5, "a b c d e f g h")])


def test_query(spark, sf, documents):
    found = {r.doc_id: r for r in QUERIES["op13_document_fingerprints"](spark, sf).collect()}
    for i, n, sha, own, new, near_edited, near_next in _expected([(r.doc_id, r.text) for r in documents.collect()]):
        r = found[i]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) == (
            n, sha, own.hex(), new.hex(), near_edited, near_next)
