"""Exact duplicates by composable polynomial fingerprints, verified chunk by chunk."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybridge.llm.common import corpus_session, joined_by_group, located, narrowed, staged, utf8

# The characters that equality ignores: [\x20\x09-\x0D].
IGNORED = b" \t\n\x0b\x0c\r"

# Bytes of a chunk, a multiple of four.
CHUNK = 1 << 16

# Two primes below 2^31 and a base for each; digits are 32-bit words of the text.
MODULI = ((2147483647, 1103515245), (2147483629, 1664525))


def _powers(base: int, modulus: int, count: int) -> np.ndarray:
    found, step = np.ones(1, np.uint64), base % modulus
    while len(found) < count:  # doubling: the second half is the first times base^len
        found = np.concatenate([found, found * np.uint64(step) % np.uint64(modulus)])
        step = step * step % modulus
    return found[:count]


_POWERS = [_powers(base, modulus, CHUNK // 4) for modulus, base in MODULI]


def chunk_prints(data: bytes, modulus: int, base: int, powers: np.ndarray) -> list[tuple[int, int]]:
    """For each chunk its fingerprint and its length in words, independently of the others."""
    words = np.frombuffer(data + bytes(-len(data) % 4), "<u4").astype(np.uint64)
    found = []
    for at in range(0, len(words), CHUNK // 4):
        chunk = words[at:at + CHUNK // 4]
        terms = chunk * powers[len(chunk) - 1::-1] % np.uint64(modulus)
        found.append((int(terms.sum()) % modulus, len(chunk)))
    return found


def combine(left: tuple[int, int], right: tuple[int, int], modulus: int, base: int) -> tuple[int, int]:
    """Fingerprint and length of two stretches put together: the left one shifted by the right one's length."""
    return (left[0] * pow(base, right[1], modulus) + right[0]) % modulus, left[1] + right[1]


def polynomial_print(data: bytes, moduli=MODULI) -> int:
    """The 62-bit fingerprint of a text of any length, composed from its chunks."""
    found = 0
    for (modulus, base), powers in zip(moduli, _POWERS):
        whole = (0, 0)
        for part in chunk_prints(data, modulus, base, powers):
            whole = combine(whole, part, modulus, base)
        found = found << 31 | whole[0]
    return found


def _prints(text: str, fold: int | None) -> Column:
    @F.arrow_udf("struct<print bigint, size bigint, sha string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = [t.translate(None, IGNORED) for t in batch.to_pylist()]
            found = [polynomial_print(t) for t in texts]
            yield pa.StructArray.from_arrays(
                [pa.array([p % fold for p in found] if fold else found, pa.int64()),
                 pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())], ["print", "size", "sha"])

    return run.asNondeterministic()(utf8(text))


def _chunks(text: str, fold: int | None) -> Column:
    @F.arrow_udf("struct<print bigint, size bigint, chunks array<binary>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = [t.translate(None, IGNORED) for t in batch.to_pylist()]
            found = [polynomial_print(t) for t in texts]
            yield pa.StructArray.from_arrays(
                [pa.array([p % fold for p in found] if fold else found, pa.int64()),
                 pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([[t[at:at + CHUNK] for at in range(0, len(t), CHUNK)] for t in texts], pa.list_(pa.binary()))],
                ["print", "size", "chunks"])

    return run.asNondeterministic()(utf8(text))


def exact_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text",
                fold: int | None = None) -> tuple[DataFrame, DataFrame, list[str]]:
    """Every row's ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``, the documents with their row columns, and these columns' names.

    Texts are equal when identical without white space ``[\\x20\\x09-\\x0D]``; null counts as empty. Of
    equal texts the one with the most code points stays, then the smallest id (a null id last), then
    one of the rows that repeat it. An empty table gives no rows.

    Fingerprints are taken chunk by chunk and composed. Rows whose fingerprint and length occur more
    than once are read again and their chunks compared: of a group, only different chunks pass the
    shuffle, so thousands of copies cost as much as one. Where a chunk differs, the group is told
    apart by the SHA-256 of its texts. ``fold`` shortens fingerprints, to test that.
    """
    corpus_session(docs.sparkSession)
    placed, place = located(docs)
    rows = staged(placed.select(*place, F.col(f"`{id}`").alias("doc_id"), _prints(text, fold).alias("p"),
                                F.coalesce(F.length(F.col(f"`{text}`")), F.lit(0)).alias("points"))
                  .select(*place, "doc_id", "points", "p.*"))
    repeated = staged(rows.groupBy("print", "size").count().where("count > 1"))
    suspects = joined_by_group(rows, repeated, ["print", "size"], "count", "left_semi").select(*place)
    pieces = (narrowed(placed, place, suspects).select(_chunks(text, fold).alias("c")).where("c.size > 0")
              .select("c.print", "c.size", F.posexplode("c.chunks").alias("number", "chunk")).distinct())
    unequal = (pieces.groupBy("print", "size", "number").count().where("count > 1").select("print", "size").distinct()
               .withColumn("unequal", F.lit(True)))
    checked = staged(repeated.join(unequal, ["print", "size"], "left"))
    told = staged(joined_by_group(rows, checked, ["print", "size"], "count", "left")
                  .withColumn("apart", F.when(F.col("unequal"), F.col("sha")).otherwise("")).drop("unequal", "count"))
    best = F.min(F.struct((-F.col("points")).alias("points"), F.col("doc_id").isNull().alias("none"), "doc_id", *place))
    groups = staged(told.groupBy("print", "size", "apart").agg(best.alias("stays"), F.count("*").alias("group_size"))
                    .where("group_size > 1"))
    is_kept = F.lit(True)
    for name in place:
        is_kept = is_kept & (F.col(name) == F.col(f"stays.{name}"))
    found = joined_by_group(told, groups, ["print", "size", "apart"], "group_size", "left")
    return found.select(
        *place, "doc_id",
        F.when(F.col("stays").isNull(), F.col("doc_id")).otherwise(F.col("stays.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.when(F.col("stays").isNull(), True).otherwise(is_kept).alias("kept"),
        F.col("sha").alias("text_sha256")), placed, place
