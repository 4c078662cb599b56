"""Run a range as one job and still tell which periods failed."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from daybridge.functions.times import as_date
from daybridge.operators.ranges import day_spine, month_spine

logger = logging.getLogger(__name__)

OUTCOME = "period date, rows long, status string, error string"


class RangeFailed(RuntimeError):
    """Some periods of a range failed; ``outcome`` holds the report of all of them."""

    def __init__(self, failed: list[dt.date], outcome: DataFrame):
        super().__init__(f"failed periods: {', '.join(d.isoformat() for d in failed)}")
        self.failed = failed
        self.outcome = outcome


LOOKBACK_DAYS = 2  # fixed value: how far before its end a range without a start begins


def backfill(spark: SparkSession, run: Callable[[dt.date, dt.date], DataFrame], start: dt.date | str | None = None,
             end: dt.date | str | None = None, step: str = "day", raise_on_failure: bool = True) -> DataFrame:
    """Call ``run(first, last)`` for the range and report ``(period, rows, status, error)``.

    ``run`` does its range in one job and returns rows per period, as ``write_partition`` does.
    When it fails, the range is halved and both halves run again, down to single periods: good
    periods are done, bad ones are named. A ``run`` that reports periods as failed itself, as exports
    with ``cast_mode="isolate"`` do, is not called again. ``raise_on_failure`` raises at the end if any failed.
    Reversed bounds do nothing. Without an end the range ends today in UTC, without a start it
    begins two days before its end.
    """
    last = as_date(end) if end is not None else dt.datetime.now(dt.timezone.utc).date()
    first = as_date(start) if start is not None else last - dt.timedelta(days=LOOKBACK_DAYS)
    spine = month_spine if step == "month" else day_spine
    periods = sorted(r.period for r in spine(spark, first, last).collect())
    outcome: list[tuple] = []
    waiting = [periods] if periods else []
    while waiting:
        part = waiting.pop()
        try:
            outcome += [(r["period"], r["rows"], r["status"], r.asDict().get("error")) for r in run(part[0], part[-1]).collect()]
        except Exception as error:  # whatever went wrong belongs in the report
            if len(part) == 1:
                logger.error("period %s failed: %s", part[0], error)
                outcome.append((part[0], None, "failed", str(error)))
            else:
                logger.warning("range %s to %s failed, trying its halves: %s", part[0], part[-1], error)
                middle = len(part) // 2
                waiting += [part[middle:], part[:middle]]
    report = spark.createDataFrame(outcome, OUTCOME)
    failed = sorted(row[0] for row in outcome if row[2] == "failed")
    if failed and raise_on_failure:
        raise RangeFailed(failed, report)
    return report
