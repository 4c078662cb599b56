"""Table scans."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybridge.functions.times import as_date


def table_scan(df: DataFrame, predicate: Column | str | None = None) -> DataFrame:
    """Every column by name in table order, with an optional predicate."""
    named = df.select(*[F.col(f"`{c}`") for c in df.columns])
    return named if predicate is None else named.where(predicate)


def snapshot(df: DataFrame, day: dt.date | str) -> DataFrame:
    """The whole table stamped with the run day, which filters nothing."""
    return df.withColumn("dt", F.lit(as_date(day)))
