"""Mixing sources to target weights by weighted sampling without replacement."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybridge.llm.common import corpus_session, fresh, staged, utf8

# Weights of the sources in their order, repeating, and how often a document may be taken.
WEIGHTS, EPOCHS = (5, 2, 1), 3

_NOT_LETTERS = bytes(b for b in range(128) if not chr(b).isalpha())
_SPACES = b" \t\n\x0b\x0c\r"


def measured(text: str) -> Column:
    """``size``, words ``[^\\x20\\x09-\\x0D]+``, and ``quality``, the share of letters in what is not space."""

    @F.arrow_udf("struct<size: bigint, quality: double>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = batch.to_pylist()
            share = [(len(t.translate(None, _NOT_LETTERS)) + 0.01) / (len(t.translate(None, _SPACES)) + 0.01) for t in texts]
            yield pa.StructArray.from_arrays([pa.array([len(t.split()) for t in texts], pa.int64()),
                                              pa.array(share, pa.float64())], ["size", "quality"])

    return run.asNondeterministic()(utf8(text))


def numbered(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """The rows with their place in the order, from 0, counted without gathering them in one task."""
    part, within, past, before = fresh(df, "part", "within", "past", "before")
    parts = staged(df.repartitionByRange(*order).sortWithinPartitions(*order)
                   .withColumn(part, F.spark_partition_id())
                   .withColumn(within, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    ends = parts.groupBy(part).agg((F.max(within) + 1).alias(past))  # a row for each partition
    starts = ends.select(part, F.coalesce(F.sum(past).over(
        Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(before))
    return parts.join(starts, part).withColumn(name, F.col(before) + F.col(within)).drop(part, within, before)


def targets(sources: DataFrame, weights: tuple[float, ...], epochs: int) -> DataFrame:
    """Rows ``source, source_size, ...`` with ``target``: weighted shares of all, none above ``epochs`` times its size.

    Sources weigh ``weights`` in turn, ordered by code point with null last. What a source cannot take
    goes to the others by weight: all not at their limit have the same target for each unit of weight.
    That level is where, by rising limit for each unit of weight, what the sources before leave of the total first
    is no more for each unit of the weight left than a source's limit: one sum over the sources in that order.
    """
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("turn") % len(weights)).cast("int") + 1)
    weighed = (numbered(sources, "turn", F.col("source").isNull(), F.col("source"))
               .withColumn("weight", turn).drop("turn")
               .withColumn("most", F.col("source_size") * float(epochs))
               .withColumn("limit", F.coalesce(F.try_divide("most", "weight"), F.lit(float("inf")))))
    weighed = staged(weighed.repartitionByRange("limit", "source").withColumn("part", F.spark_partition_id()))
    total = F.sum("source_size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy("part").rowsBetween(1, Window.unboundedFollowing)
    parts = weighed.groupBy("part").agg(*[F.sum(c).alias(c) for c in ("source_size", "most", "weight")]).select(
        "part", total.alias("total"), F.coalesce(F.sum("most").over(before), F.lit(0.0)).alias("given"),
        F.coalesce(F.sum("weight").over(after), F.lit(0.0)).alias("behind"))
    order = Window.partitionBy("part").orderBy("limit", "source")
    given = F.col("given") + F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.col("behind") + F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    level = (weighed.join(parts, "part").select("limit", "source", F.try_divide(F.col("total") - given, left).alias("level"))
             .where("level <= limit").agg(F.min_by("level", F.struct("limit", "source"))).first()[0])
    level = sys.float_info.max if level is None else level
    return (weighed.withColumn("target", F.least(F.col("most"), F.col("weight") * F.lit(level)))
            .drop("most", "weight", "limit", "part"))


def mix(docs: DataFrame, id: str = "doc_id", source: str = "source", text: str = "text",
        weights: tuple[float, ...] = WEIGHTS, epochs: int = EPOCHS, seed: int = 7) -> DataFrame:
    """A row for each document: ``doc_id, source, size, source_size, target, taken``.

    ``size`` is the document's words (null text: 0), ``target`` the words its source is to give (see
    ``targets``), ``taken`` the words the mix takes of this document, repeats counted: as many whole
    epochs of the source as fit the target, then documents in the order of their keys up to the rest;
    the one that crosses it gives its first words only, so a source meets its target to the word.
    Keys are exponential with the document's share of letters as rate, from a hash of its id: reruns
    agree, and better documents come first more often. A null id has a hash as well; repeated rows
    have equal keys and count one by one; null is a source of its own. An empty table gives no rows.

    Only ids, sources and sizes are shuffled. Rows are cut by ranges of source and key and summed up
    range by range, so a source with a third of all rows, of whatever quality, is spread like any other.
    """
    corpus_session(docs.sparkSession)
    chance = (F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(1 << 53)) + 0.5) / float(1 << 53)
    rows = staged(docs.select(F.col(f"`{id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"),
                              measured(text).alias("m"))
                  .select("doc_id", "source", "m.size", (-F.log(chance) / F.col("m.quality")).alias("key")))
    # Null is a source of its own: sources are matched by name and by whether they have one.
    name = [F.coalesce(F.col("source").cast("string"), F.lit("")).alias("name"), F.isnull("source").alias("unnamed")]
    sources = staged(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, epochs)
                     .select(*name, "source_size", "target"))
    cut = staged(rows.select("*", *name).repartitionByRange("name", "unnamed", "key", "doc_id", "size")
                 .withColumn("part", F.spark_partition_id()))
    part = ["name", "unnamed", "part"]
    ahead = (F.sum("words").over(Window.partitionBy("name", "unnamed").orderBy("part")
                                 .rowsBetween(Window.unboundedPreceding, -1)))
    parts = (cut.groupBy(*part).agg(F.sum("size").alias("words")).join(sources, ["name", "unnamed"])
             .select(*part, "source_size", "target", F.coalesce(ahead, F.lit(0)).alias("ahead")))
    within = F.sum("size").over(Window.partitionBy(*part).orderBy("key", "doc_id", "size")
                                .rowsBetween(Window.unboundedPreceding, -1))
    summed = cut.withColumn("within", F.coalesce(within, F.lit(0))).join(parts, part)
    words = F.round("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0)
    rest = words - whole * F.col("source_size")
    rest_taken = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("ahead") - F.col("within")))
    return summed.select("doc_id", "source", "size", "source_size", "target",
                         (whole * F.col("size") + rest_taken).cast("long").alias("taken"))
