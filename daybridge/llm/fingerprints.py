"""Document fingerprints: one-permutation MinHash, optimally densified, of which the low-order bits are packed."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybridge.llm.common import corpus_session, located, spaced_words, staged, utf8

# Words of a shingle; bins of a fingerprint and the bits kept of each.
WORDS, BINS, BITS = 5, 512, 4

# A word's number is the first 32 bits of its MD5. A shingle's numbers are the digits of two
# numbers modulo primes below 2^31: one deals it to a bin, the other is its hash there.
BIN_HASH, VALUE_HASH = (2147483647, 1103515245), (2147483629, 1664525)

# The d-th draw of bin i is (FACTOR^(d+1) * (i + 1) + SHIFT * d) modulo PRIME, modulo the bins.
# After so many draws that found only empty bins, the first filled one is taken.
FACTOR, SHIFT, PRIME, DRAWS = 48271, 69621, 2147483647, 2048

# Bytes of text whose words are held as Python objects at a time, and words remembered with their numbers.
PIECE, REMEMBERED = 1 << 20, 1 << 18

EMPTY = np.iinfo(np.int64).max

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = int.from_bytes(hashlib.md5(word).digest()[:4], "big")
        return number


_numbers = _Numbers()


def _word_numbers(text: bytes) -> Iterator[np.ndarray]:
    """The numbers of all words in order, piece by piece; pieces end where white space does."""
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            space = _SPACE.search(text, end)
            end = space.start() if space else len(text)
        words = spaced_words(text[at:end])
        if len(_numbers) > REMEMBERED:
            _numbers.clear()
        yield np.fromiter(map(_numbers.__getitem__, words), np.int64, len(words))
        at = end


def _digits(numbers: np.ndarray, words: int, prime: int, base: int) -> np.ndarray:
    count = len(numbers) - words + 1
    found = numbers[:count] % prime
    for i in range(1, words):
        found = (found * base + numbers[i:i + count]) % prime
    return found


def minima(text: bytes, bins: int = BINS) -> np.ndarray:
    """The least hash of each bin over all shingles, hashed once; EMPTY in bins without any.

    Words are lower-cased (A-Z) and end at white space. A text of fewer words than a shingle is one shingle.
    """
    least = np.full(bins, EMPTY)
    tail, longer = np.empty(0, np.int64), False

    def put(numbers: np.ndarray, words: int) -> None:
        np.minimum.at(least, _digits(numbers, words, *BIN_HASH) % bins, _digits(numbers, words, *VALUE_HASH))

    for numbers in _word_numbers(text):
        tail = np.concatenate([tail, numbers])
        if len(tail) >= WORDS:
            put(tail, WORDS)
            tail, longer = tail[len(tail) - WORDS + 1:], True
    if len(tail) and not longer:
        put(tail, len(tail))
    return least


@cache
def _draws(bins: int) -> np.ndarray:
    powers, found = 1, np.empty((DRAWS, bins), np.int32)
    for d in range(DRAWS):
        powers = powers * FACTOR % PRIME
        found[d] = (powers * np.arange(1, bins + 1) + SHIFT * d) % PRIME % bins
    return found


def densified(least: np.ndarray) -> np.ndarray:
    """Each empty bin takes the value of the first filled bin among its draws.

    The draws depend on the bin's number alone, so in two texts an empty bin borrows alike, and each borrows
    independently of the others: no run of empty bins repeats one neighbour.
    """
    full = least != EMPTY
    empty = np.flatnonzero(~full)
    if not len(empty) or len(empty) == len(least):
        return least
    found = least.copy()
    found[empty] = least[full.argmax()]
    if full.sum() > 1:
        draws = _draws(len(least))
        for d in range(0, DRAWS, 32):
            drawn = draws[d:d + 32, empty]
            hit = full[drawn]
            some = hit.any(0)
            found[empty[some]] = least[drawn[hit.argmax(0), np.arange(len(empty))][some]]
            empty = empty[~some]
            if not len(empty):
                break
    return found


def fingerprint(text: bytes, bins: int = BINS, bits: int = BITS) -> bytes:
    """The low ``bits`` of each bin's minimum, packed; nothing for a text without words."""
    least = densified(minima(text, bins))
    if least[0] == EMPTY:
        return b""
    return np.packbits((least[:, None] >> np.arange(bits - 1, -1, -1) & 1).astype(np.uint8)).tobytes()


def likeness(a: bytes, b: bytes, bins: int = BINS, bits: int = BITS) -> float:
    """The estimated share of common shingles: equal bins, less those that are equal by chance.

    Low-order bits of different minima agree with probability ``2 ** -bits``. Two texts without words are
    alike, a text without words is unlike any other.
    """
    if not a or not b:
        return float(a == b)
    x, y = (np.unpackbits(np.frombuffer(p, np.uint8))[:bins * bits].reshape(bins, bits) for p in (a, b))
    equal, chance = int((x == y).all(1).sum()) / bins, 2.0 ** -bits
    return min(max((equal - chance) / (1 - chance), 0.0), 1.0)


def fingerprints(text: str, bins: int = BINS, bits: int = BITS) -> Column:
    """The fingerprints of a text column, binary; null counts as empty, without words it is empty."""

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([fingerprint(t, bins, bits) for t in batch.to_pylist()], pa.binary())

    return run.asNondeterministic()(utf8(text))


def likenesses(a: str, b: str, bins: int = BINS, bits: int = BITS) -> Column:
    """The likeness of two columns of fingerprints, 0 to 1."""

    @F.arrow_udf("double")
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            yield pa.array([likeness(x, y, bins, bits) for x, y in zip(left.to_pylist(), right.to_pylist())], pa.float64())

    return run(F.col(a), F.col(b))


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the following text, or all it has."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_RESULTS = ("n_chars bigint, edited_sha256 string, fingerprint binary, edited_fingerprint binary, "
            "near_edited double, near_next double")


def _told(text: bytes, print_: bytes, following: bytes, next_print: bytes, bins: int, bits: int) -> tuple:
    whole = text.decode()
    new = edited(whole, following.decode()).encode()
    new_print = fingerprint(new, bins, bits)
    return (len(whole), hashlib.sha256(new).hexdigest(), print_, new_print,
            likeness(print_, new_print, bins, bits), likeness(print_, next_print, bins, bits))


def with_next(docs: DataFrame, id: str = "doc_id", text: str = "text", bins: int = BINS,
              bits: int = BITS) -> tuple[DataFrame, DataFrame, list[str]]:
    """Every row's fingerprint, its edited text's, and what they have in common with each other and the next
    row's; the documents with their row columns, and these columns' names.

    The next row is the one with the next larger id; equal ids follow each other by row, null ids stand last,
    and the first row comes after the last. The edited text has its last half replaced by the start of the
    next row's. A single row is its own next. An empty table gives no rows. Null counts as empty, and
    equal texts have equal fingerprints.

    Rows are cut by ranges of id and row, so neither one frequent id nor one without value fills a task. A task
    goes through its range in order and holds two texts at a time; the last row of each range is finished with
    the first of the next range that has any. The driver sees the numbers of the ranges alone.
    """
    corpus_session(docs.sparkSession)
    placed, place = located(docs)
    order = [F.col("doc_id").isNull(), F.col("doc_id"), *[F.col(p) for p in place]]
    rows = placed.select(*place, F.col(f"`{id}`").alias("doc_id"), utf8(text).alias("text"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    kept = ", ".join(f"`{c}` {kinds[c]}" for c in [*place, "doc_id"])
    # of the first row of a range its text and fingerprint, of the last one too; of the others the results
    schema = f"{kept}, state string, range int, text binary, print binary, told struct<{_RESULTS.replace(' ', ': ').replace(',:', ',')}>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, last = TaskContext.get().partitionId(), None
        names = [*place, "doc_id", "state", "range", "text", "print", "told"]
        types = None

        def out(found: list[tuple]) -> pa.RecordBatch:
            told = [None if r[-1] is None else dict(zip(results, r[-1])) for r in found]
            columns = [pa.array([r[i] for r in found], t) for i, t in enumerate(types)]
            columns += [pa.array([r[-5] for r in found], pa.string()), pa.array([r[-4] for r in found], pa.int32()),
                        pa.array([r[-3] for r in found], pa.binary()), pa.array([r[-2] for r in found], pa.binary()),
                        pa.array(told, struct)]
            return pa.record_batch(columns, names)

        for batch in batches:
            types, found = batch.schema.types[:-1], []
            columns = [batch.column(i) for i in range(batch.num_columns)]
            for i in range(batch.num_rows):
                *own, data = [c[i].as_py() for c in columns]
                own_print = fingerprint(data, bins, bits)
                if last:
                    found.append((*last[0], "done", number, None, None, _told(*last[1:], data, own_print, bins, bits)))
                else:
                    found.append((*own, "first", number, data, own_print, None))
                last = own, data, own_print
            yield out(found)
        if last:
            yield out([(*last[0], "last", number, *last[1:], None)])

    results = [r.split(" ")[0] for r in _RESULTS.split(", ")]
    struct = pa.struct(list(zip(results, [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()])))
    found = staged(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema))
    ranges = sorted(r["range"] for r in found.where("state = 'last'").select("range").collect())
    follows = docs.sparkSession.createDataFrame([(a, b) for a, b in zip(ranges, ranges[1:] + ranges[:1])], "range int, next int")

    @F.arrow_udf(f"struct<{_RESULTS.replace(' ', ': ').replace(',:', ',')}>")
    def finish(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in batches:
            told = [_told(*row, bins, bits) for row in zip(*[c.to_pylist() for c in batch])]
            yield pa.array([dict(zip(results, t)) for t in told], struct)

    heads = found.where("state = 'first'").select(F.col("range").alias("next"), F.col("text").alias("next_text"),
                                                  F.col("print").alias("next_print"))
    ends = (found.where("state = 'last'").join(F.broadcast(follows), "range").join(heads, "next")
            .withColumn("told", finish("text", "print", "next_text", "next_print")))
    columns = [*place, "doc_id", "told.*"]
    return found.where("state = 'done'").select(*columns).unionByName(ends.select(*columns)), placed, place
