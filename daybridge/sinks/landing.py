"""Landing tables: raw JSON records, one day partition per load."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybridge.functions.times import as_date
from daybridge.sinks.files import EmptyExport
from daybridge.sinks.partitions import REPORT, counted, drop_staged, observed, publish, staged_path

ON_EMPTY = ("skip", "error")

LANDED = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("raw_data", T.StringType(), True),
    T.StructField("created_at", T.TimestampType(), False),
])


def land(records: DataFrame, path: str, at: dt.datetime | dt.date | str | None = None,
         on_empty: str = "skip", column: str = "record") -> DataFrame:
    """Write cleaned JSON records as ``(id, raw_data, created_at)`` and replace their day partitions.

    ``at`` is the load time of every record; without it each record lands at midnight of its own
    ``dt``, so a range of days lands in one job. No records leaves the table as it was, and with
    ``on_empty="error"`` raises. Ids are random and drawn in the writing stage. Days are replaced only when
    the files hold the records that the job observed.
    """
    if on_empty not in ON_EMPTY:
        raise ValueError(f"on_empty must be one of {ON_EMPTY}, not {on_empty!r}")
    spark = records.sparkSession
    if at is None:
        missing = F.raise_error(F.lit("record without a day")).cast("date")
        day = F.when(F.col("dt").isNotNull(), F.col("dt").cast("date")).otherwise(missing)
        created = day.cast("timestamp")
    else:
        moment = at if isinstance(at, dt.datetime) else dt.datetime.combine(as_date(at), dt.time())
        moment = (moment if moment.tzinfo else moment.replace(tzinfo=dt.timezone.utc)).astimezone(dt.timezone.utc)
        day = F.lit(moment.date())
        created = F.lit(moment.isoformat()).cast("timestamp")
    landed = records.select(day.alias("dt"), F.uuid().alias("id"), F.col(column).alias("raw_data"),
                            created.alias("created_at"))
    seen = Observation()
    landed = landed.observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set("dt").alias("days"))
    stage = staged_path(path)
    try:
        landed.write.partitionBy("dt").option("compression", "gzip").parquet(stage)
        found = observed(seen)
        rows, days = found.get("rows", 0), sorted(found.get("days", []))
        if rows == 0 and on_empty == "error":
            raise EmptyExport(f"no records to land in {path}")
        held = counted(spark, stage, path, "dt", LANDED, days, rows)
    except BaseException:
        drop_staged(spark, stage)
        raise
    publish(spark, stage, path, "dt", days, [])
    return spark.createDataFrame([(d, n, "replaced") for d, n in sorted(held.items())], REPORT)
