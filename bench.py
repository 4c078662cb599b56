"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data (default sf0.1), BENCH_CPUS the local threads (default 8). Every query
runs once unmeasured, so the figures leave out code generation and first reads, then once measured.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession

from daybridge.operators.finance import financial_daily
from daybridge.session import prepare
from bridgecheck.queries import QUERIES
from bridgecheck.views import view

HEADLINE = ["financial_daily", "financial_monthly", "raw_orders", "raw_refunds", "table_scan_predicate",
            "partner_events", "json_null_cleaning", "conform_struct", "conform_array", "range_report",
            "backfill_months", "partition_replace", "export_partner_day_files", "json_export", "land_log_records",
            "wrapped_parquet", "api_envelope", "catalogue_documents"]

LOOP_DAYS = 31


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run) -> float:
    started = time.perf_counter()
    run()
    return round(time.perf_counter() - started, 3)


def one_job_against_day_by_day(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    """A month of daily financials in one job, and as one job per day."""
    orders = view(spark, sf_dir, "mart_orders")
    first = dt.date(1995, 3, 1)
    days = [first + dt.timedelta(days=i) for i in range(LOOP_DAYS)]

    def whole():
        drain(financial_daily(orders, days[0], days[-1]))

    def loop():
        for day in days:
            drain(financial_daily(orders, day, day))

    whole()
    return {"days": LOOP_DAYS, "one_job": timed(whole), "day_by_day": timed(loop)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
             .config("spark.driver.memory", "12g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    seconds = {}
    for name in HEADLINE:
        drain(QUERIES[name](spark, sf_dir))
        seconds[name] = timed(lambda: drain(QUERIES[name](spark, sf_dir)))
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
        "range": one_job_against_day_by_day(spark, sf_dir)}))
    spark.stop()


if __name__ == "__main__":
    main()
