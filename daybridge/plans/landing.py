"""Landing jobs: partner files and API responses into raw JSON tables."""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybridge.functions.jsontext import row_record
from daybridge.functions.times import as_date
from daybridge.operators.ranges import day_spine
from daybridge.session import work_folder
from daybridge.sinks.landing import land
from daybridge.sinks.partitions import REPORT, holds_rows, observed, write_partition
from daybridge.sources.envelope import unwrap_envelope
from daybridge.sources.landed import (day_folders, landed_files, parse_log_lines, read_log_lines,
                                      read_wrapped_parquet, wrapped_schema)

logger = logging.getLogger(__name__)

REJECTED = ["dt", "source_file", "line", "error"]


PART_BYTES = 8 * 1024 * 1024  # compressed; JSON logs unpack to five to ten times that


def _dealt_out(rows: DataFrame) -> DataFrame:
    """A gzip file is read by one task. Rows are spread before the costly part, making records: each
    file over as many parts as its size asks for, so that days of small files are still written by
    one task."""
    parts = F.ceil(F.col("source_bytes") / F.lit(PART_BYTES)).cast("long")
    dealt = rows.withColumn("part", F.pmod(F.monotonically_increasing_id(), F.greatest(parts, F.lit(1))))
    return dealt.hint("rebalance", "dt", "part").drop("part")


def _log_records(spark: SparkSession, path: str, unreadable: str) -> DataFrame:
    lines = _dealt_out(read_log_lines(spark, path, unreadable=unreadable))
    return parse_log_lines(lines).select("dt", "source_file", "line", "record", "error")


def _parquet_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    rows = _dealt_out(read_wrapped_parquet(spark, path, schema))
    record = F.when(F.col("error").isNull(), row_record(rows, schema.names))
    return rows.select("dt", "source_file", F.lit(None).cast("string").alias("line"), record.alias("record"), "error")


def file_records(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 unreadable: str = "fail") -> DataFrame | None:
    """Records of all landed files below a path: ``(dt, source_file, line, record, error)``.

    None where there are no such files. Without a ``schema`` the columns of wrapped Parquet are
    looked up in the files.
    """
    is_parquet = F.col("path").endswith(".parquet.gz")
    found = landed_files(spark, path).agg(
        F.count_if(~is_parquet).alias("logs"), F.count_if(is_parquet).alias("parquets")).first()
    parts = []
    if found.logs:
        parts.append(_log_records(spark, path, unreadable))
    if found.parquets:
        parts.append(_parquet_records(spark, path, schema or wrapped_schema(spark, path)))
    if not parts:
        logger.warning("no landed files below %s", path)
        return None
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _land_files(source: str, table: str, spine: DataFrame, at: dt.date | None, schema: T.StructType | None,
                rejects: str | None, unreadable: str) -> DataFrame:
    spark = spine.sparkSession
    records = file_records(spark, source, schema, unreadable)
    if records is None:
        return spark.createDataFrame([], REPORT)
    seen = Observation()
    watched = records.observe(seen, F.count_if(F.col("error").isNotNull()).alias("rejected"))
    report = land(watched.where("error IS NULL"), table, at)
    rejected = observed(seen).get("rejected", 0)
    if rejected:
        logger.warning("%s: %d records rejected", source, rejected)
    rejects = rejects or f"{table.rstrip('/')}_rejects"
    if rejected or holds_rows(spark, rejects):
        # Read again only when there is something to keep; old rejects of the days go either way.
        bad = records.where("error IS NOT NULL") if rejected else spark.createDataFrame([], records.schema)
        if at is not None:
            bad = bad.withColumn("dt", F.lit(at))
        write_partition(bad.select(*REJECTED), rejects, spine=spine, mark_empty=False)
    return report


def land_files(spark: SparkSession, source: str, table: str, day: dt.date | str,
               schema: T.StructType | None = None, rejects: str | None = None,
               unreadable: str = "fail") -> DataFrame:
    """Load every landed file below ``source`` as the given day, replacing that day of the table.

    No files or no records leaves the table as it was. Lines that are not JSON and files that are
    not Parquet go to ``rejects``, by default the table's path with ``_rejects``, while the others load.
    """
    with work_folder(spark):
        return _land_files(source, table, day_spine(spark, day, day), as_date(day), schema, rejects, unreadable)


def land_days(spark: SparkSession, root: str, table: str, start: dt.date | str, end: dt.date | str,
              schema: T.StructType | None = None, rejects: str | None = None,
              unreadable: str = "fail") -> DataFrame:
    """Load the day folders of a range below ``root`` in one job, each into its own day.

    A day without files or records keeps what the table has and is reported as ``untouched``.
    """
    spine = day_spine(spark, start, end)
    days = [r.period for r in spine.collect()]
    if not days:
        return spark.createDataFrame([], REPORT)
    with work_folder(spark):
        report = _land_files(day_folders(root, days), table, spine, None, schema, rejects, unreadable)
    return spine.join(report, "period", "left").select(
        "period", F.coalesce("rows", F.lit(0)).alias("rows"), F.coalesce("status", F.lit("untouched")).alias("status"))


def land_rows(rows: DataFrame, table: str, day: dt.date | str | None = None) -> DataFrame:
    """Load the rows of a table, such as an export read back, as JSON records.

    They land on ``day``, or each on the day in its ``dt`` column, which is then no part of the record.
    A day's rows are brought together first, so that files do not multiply as tasks x days.
    """
    rows = rows.hint("rebalance") if day is not None else rows.hint("rebalance", "dt")
    columns = [c for c in rows.columns if day is not None or c != "dt"]
    days = F.lit(as_date(day)) if day is not None else F.col("dt")
    records = rows.select(row_record(rows, columns).alias("record"), days.alias("dt"))
    return land(records, table)


def land_responses(responses: DataFrame, column: str, table: str, at: dt.datetime) -> DataFrame:
    """Load landed API responses, keeping the time of day; bad responses and no records are errors."""
    return land(unwrap_envelope(responses, column), table, at, on_empty="error")
