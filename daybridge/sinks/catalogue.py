"""XML catalogue files: a folder per merchant, numbered fragments inside."""

from __future__ import annotations

import datetime as dt
import logging
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybridge.operators.catalogue import (OFFER_CLOSE, catalogue_lite, catalogue_offers,
                                           document_open, merchants)
from daybridge.session import shared_folder, work_folder

logger = logging.getLogger(__name__)

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 * 1024 * 1024

# Bytes that a task of the write sorts, about, and that an offer takes: an element of some ten short fields.
TASK_BYTES, OFFER_BYTES = 128 * 1024 * 1024, 512


def _numbered(offers: DataFrame, split: DataFrame) -> DataFrame:
    """Offers with the fragment they go to; only merchants of several fragments need a lookup.

    Row positions deal the offers of those out evenly, copies of one product included. They are
    written to the shared folder first: read from there, a task that runs again sees its rows in
    the same order, whatever the offers came from.
    """
    size = split.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("mercant_id") + 8).alias("bytes")).first()
    if size.n == 0:
        return offers.withColumn("fragment", F.lit(0).cast("long"))
    small = size.n <= BROADCAST_ROWS and size.bytes <= BROADCAST_BYTES
    split = F.broadcast(split) if small else split
    stage = shared_folder(offers.sparkSession)
    large = offers.join(split, "mercant_id")
    large.write.parquet(stage)
    placed = offers.sparkSession.read.schema(large.schema).parquet(stage).withColumn(
        "fragment", F.pmod(F.monotonically_increasing_id(), "fragments")).drop("fragments")
    return placed.unionByName(offers.join(split, "mercant_id", "left_anti").withColumn("fragment", F.lit(0).cast("long")))


def catalogue_lines(offers: DataFrame, known: DataFrame, generated_at: dt.datetime) -> DataFrame:
    """Everything that makes up the documents: ``(mercant_id, fragment, kind, offer_id, value)``.

    ``known`` is what ``merchants`` gives. Ordered by kind and offer id, the values of a merchant's
    fragment are a document.
    """
    body = _numbered(offers, known.where("fragments > 1").select("mercant_id", "fragments")).select(
        "mercant_id", "fragment", F.lit(1).alias("kind"), "offer_id", F.col("offer").alias("value"))
    every = known.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("fragments") - 1)).alias("fragment"))
    head = every.select("mercant_id", "fragment", F.lit(0).alias("kind"), F.lit("").alias("offer_id"),
                        document_open(generated_at).alias("value"))
    tail = every.select("mercant_id", "fragment", F.lit(2).alias("kind"), F.lit("").alias("offer_id"),
                        F.lit(OFFER_CLOSE).alias("value"))
    return body.unionByName(head).unionByName(tail)


def catalogue_xml(df: DataFrame, path: str, day: dt.date | str | None = None,
                  generated_at: dt.datetime | None = None, max_offers: int = 200_000) -> None:
    """Publish XML documents per merchant below ``path``, replacing what is there.

    A file ``mercant_id=…/fragment=…`` is a complete document of about ``max_offers`` offers at
    most; a merchant has as many as it needs, normally one, written by as many tasks. No task holds
    more than one fragment's rows of a merchant at a time, and none is held in memory as a whole.
    """
    moment = generated_at or dt.datetime.now()
    offers = catalogue_offers(df, day)
    known = merchants(offers, max_offers).persist()
    try:
        # A fragment has to stay in one task, so partitions cannot be cut later: their number follows the bytes of
        # the counted offers. Files cost time whatever they hold, so there are also as many as the session has
        # partitions, or fragments if these are fewer; adaptive execution would put small ones into one task.
        usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        total = known.agg(F.sum("offers").alias("offers"), F.sum("fragments").alias("fragments")).first()
        by_bytes = math.ceil((total["offers"] or 0) * OFFER_BYTES / TASK_BYTES)
        parts = max(1, by_bytes, min(usual, total["fragments"] or 0))
        with work_folder(df.sparkSession):
            (catalogue_lines(offers, known, moment)
             .repartition(parts, "mercant_id", "fragment")
             .sortWithinPartitions("mercant_id", "fragment", "kind", "offer_id")
             .select("mercant_id", "fragment", "value")
             # Static whatever the session says: fragments of an earlier, larger document must go.
             .write.partitionBy("mercant_id", "fragment").mode("overwrite")
             .option("partitionOverwriteMode", "static").text(path))
    finally:
        known.unpersist()


def catalogue_xml_lite(df: DataFrame, path: str, generated_at: dt.datetime | None = None,
                       order_by: str | None = None, rows: int | None = None, max_offers: int = 200_000) -> bool:
    """Write the brief document over all products; False and nothing written when there are none.

    A file ``fragment=…`` is a complete document of about ``max_offers`` products at most. Only with
    ``rows``, which needs ``order_by``, are there no more products than that.
    """
    lines = catalogue_lite(df, generated_at or dt.datetime.now(), order_by, rows, max_offers)
    if lines is None:
        logger.warning("no products for %s", path)
        return False
    (lines.repartition("fragment").sortWithinPartitions("fragment", "kind", "position").select("fragment", "value")
     .write.partitionBy("fragment").mode("overwrite").option("partitionOverwriteMode", "static").text(path))
    return True
