"""Exports of datasets to date-partitioned Parquet."""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from daybridge.operators import finance
from daybridge.operators.conform import conform, loss_counts, lost_leaf
from daybridge.operators.filters import in_days, partner_events
from daybridge.operators.ranges import day_spine, month_spine
from daybridge.plans.datasets import DATASETS, Dataset
from daybridge.sinks.partitions import observed, write_partition, write_split
from daybridge.sources.scans import snapshot, table_scan

Day = dt.date | str

logger = logging.getLogger(__name__)


# The column that says why a row fails its period.
_WHY = "_why_it_fails"


class _Shaped:
    """Rows in the declared shape; a permissive cast counts its losses in the job that writes them.

    With ``isolate`` a value that does not fit fails its period and no other, in that same job: rows are
    cast permissively, and ``failing`` names the column that ``write_partition`` is told of.
    """

    def __init__(self, rows: DataFrame, dataset: Dataset, cast_mode: str, nested_as: str = "array"):
        self.name, self.seen, self.failing = dataset.name, None, None
        schema = dataset.schema(nested_as)
        if cast_mode == "isolate":
            self.failing = _WHY
            why = F.concat(F.lit("values that do not fit: "), lost_leaf(rows, schema))
            self.rows = conform(rows.withColumn(_WHY, why), schema, "permissive", keep=("dt", _WHY))
            return
        counts = loss_counts(rows, schema) if cast_mode == "permissive" else {}
        if counts:
            self.seen, self.paths = Observation(), list(counts)
            rows = rows.observe(self.seen, *[count.alias(f"n{i}") for i, count in enumerate(counts.values())])
        self.rows = conform(rows, schema, cast_mode, keep=("dt",))

    def report(self, done: DataFrame) -> DataFrame:
        """The write's report, after a warning that names the leaves with losses.

        Counted before the shuffle of the write, so a task that ran twice may count twice.
        """
        found = observed(self.seen) if self.seen else {}
        lost = {path: found.get(f"n{i}") for i, path in enumerate(self.paths)} if found else {}
        if any(lost.values()):
            logger.warning("%s: values that do not fit became NULL: %s", self.name,
                           ", ".join(f"{path}: {n}" for path, n in lost.items() if n))
        return done


def export_days(source: DataFrame, name: str, path: str, start: Day, end: Day,
                predicate: Column | str | None = None, cast_mode: str = "strict",
                nested_as: str = "array", layout: str | None = None, mark_empty: bool = True) -> DataFrame:
    """Write the days of a dataset filtered by its day column; one job for the range.

    ``cast_mode="strict"`` fails the range on a value that does not fit, ``"permissive"`` makes it NULL, and
    ``"isolate"`` fails its day alone: the day stays as it was and is reported, the others are published.
    For a source whose files already hold one day each, ``layout="as_is"`` saves the shuffle that
    brings the rows of a day together, and a long sparse range may do without empty files
    (``mark_empty``); see ``write_partition``.
    """
    dataset = DATASETS[name]
    if dataset.day_column is None:
        raise ValueError(f"{name} is a snapshot, use export_snapshot")
    rows = in_days(table_scan(source, predicate), dataset.day_column, start, end)
    rows = rows.withColumn("dt", F.to_date(dataset.day_column))
    spine = day_spine(source.sparkSession, start, end)
    shaped = _Shaped(rows, dataset, cast_mode, nested_as)
    return shaped.report(write_partition(shaped.rows, path, mode=dataset.mode, spine=spine, layout=layout,
                                         mark_empty=mark_empty, failing=shaped.failing))


def export_snapshot(source: DataFrame, name: str, path: str, day: Day, cast_mode: str = "strict") -> DataFrame:
    """Write the whole table into the folder of the run day, replacing or appending as declared."""
    dataset = DATASETS[name]
    if dataset.day_column is not None:
        raise ValueError(f"{name} is exported by day, use export_days")
    shaped = _Shaped(snapshot(table_scan(source), day), dataset, cast_mode)
    return shaped.report(write_partition(shaped.rows, path, mode=dataset.mode,
                                         spine=day_spine(source.sparkSession, day, day), failing=shaped.failing))


def export_partner_events(source: DataFrame, path: str, start: Day, end: Day, agent: str, app: str,
                          max_bytes: int | None = None, cast_mode: str = "strict") -> DataFrame:
    """Write the partner's events of every day; ``max_bytes`` bounds the files."""
    rows = partner_events(source, start, agent, app, end).withColumn("dt", F.to_date("event_time"))
    shaped = _Shaped(rows, DATASETS["analytics_events"], cast_mode)
    spine = day_spine(source.sparkSession, start, end)
    # The filter keeps few rows of many scan tasks, so files are put together even for one day.
    if max_bytes is None:
        return shaped.report(write_partition(shaped.rows, path, spine=spine, layout="clustered",
                                             failing=shaped.failing))
    return shaped.report(write_split(shaped.rows, path, max_bytes, spine=spine, failing=shaped.failing))


_FINANCIAL = {
    "financial_daily": finance.financial_daily,
    "financial_monthly": finance.financial_monthly,
    "financial_raw": finance.raw_orders,
    "refunds_raw": finance.raw_refunds,
}


def export_financial(source: DataFrame, name: str, path: str, start: Day, end: Day,
                     cast_mode: str = "strict", layout: str | None = None, mark_empty: bool = True) -> DataFrame:
    """Write one of the financial datasets for every day or month of the range; one job."""
    dataset = DATASETS[name]
    shaped = _Shaped(_FINANCIAL[name](source, start, end), dataset, cast_mode)
    spine = month_spine if dataset.step == "month" else day_spine
    return shaped.report(write_partition(shaped.rows, path, spine=spine(source.sparkSession, start, end),
                                         layout=layout, mark_empty=mark_empty, failing=shaped.failing))
