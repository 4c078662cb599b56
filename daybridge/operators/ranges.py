"""Period spines and the per-period report of a range job."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybridge.functions.times import as_date, day_sequence


def _spine(spark: SparkSession, start: dt.date | str, end: dt.date | str, step: str) -> DataFrame:
    periods = day_sequence(F.lit(as_date(start)), F.lit(as_date(end)), step)
    return spark.range(0, 1, 1, 1).select(F.explode(periods).alias("period"))


def day_spine(spark: SparkSession, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """One row per day, both ends included; no rows when the bounds are reversed."""
    return _spine(spark, start, end, "day")


def month_spine(spark: SparkSession, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """One row per month, as its first day; the days of the bounds do not matter."""
    return _spine(spark, start, end, "month")


def spine_of(df: DataFrame, column: str, step: str = "day") -> DataFrame:
    """The spine from the earliest to the latest period found in a column."""
    bounds = df.agg(F.to_date(F.min(column)).alias("first"), F.to_date(F.max(column)).alias("last"))
    return bounds.select(F.explode(day_sequence(F.col("first"), F.col("last"), step)).alias("period"))


def range_report(result: DataFrame, spine: DataFrame, column: str = "dt") -> DataFrame:
    """Rows per period of the spine, periods without rows included.

    The result is folded to one row per period before it meets the spine, so the join never sees
    more than periods on either side.
    """
    counts = result.groupBy(F.col(column).cast("date").alias("period")).agg(F.count(F.lit(1)).alias("rows"))
    return spine.join(counts, "period", "left").select(
        "period",
        F.coalesce("rows", F.lit(0)).alias("rows"),
        F.when(F.col("rows") > 0, F.lit("ok")).otherwise(F.lit("empty")).alias("status"),
    )
