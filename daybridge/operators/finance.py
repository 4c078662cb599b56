"""Financial aggregates and the raw order and refund projections."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybridge.functions.times import day_text, month_start, month_text, second_text
from daybridge.operators.filters import (CANCELLED, exclude_full_refunds, exclude_status, in_days,
                                         in_months)


def _average_of_cents(df: DataFrame, column: str) -> Column:
    """The mean to two digits, rounded once, halves away from zero; exact for decimals."""
    kind = df.schema[column].dataType
    if not isinstance(kind, T.DecimalType):
        return F.round(F.avg(column), 2)
    scale = max(kind.scale, 2)
    units = F.sum((F.col(column) * F.lit(10 ** scale)).cast("decimal(38,0)"))
    parts = F.count(column) * F.lit(10 ** (scale - 2))
    cents = F.call_function("div", 2 * F.abs(units) + parts, 2 * parts)
    return F.when(F.count(column) > 0, F.signum(units) * cents / 100)


def _measures(df: DataFrame, period_text: Column, discounted: bool) -> list[Column]:
    shared = [
        period_text,
        F.count_distinct("warehouse_id").alias("active_darkstores"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("order_id").alias("orders"),
        _average_of_cents(df, "original_price").alias("aov"),
        F.sum("original_price").alias("gmv"),
    ]
    if discounted:
        shared += [
            F.sum("oi_price").alias("gmv_disc"),
            F.sum(F.col("original_price") - F.col("oi_price")).alias("incentives"),
        ]
    return shared + [
        F.sum("delivery_fee_price").alias("delivery_fee_revenue"),
        F.sum("service_fee_price").alias("service_fee_revenue"),
    ]


def _as_doubles(df: DataFrame) -> DataFrame:
    money = {"aov", "gmv", "gmv_disc", "incentives", "delivery_fee_revenue", "service_fee_revenue", "gtv"}
    return df.select(*[F.col(c).cast("double").alias(c) if c in money else F.col(c) for c in df.columns])


def financial_daily(orders: DataFrame, start: dt.date | str, end: dt.date | str,
                    excluded_status: int = CANCELLED) -> DataFrame:
    """Eleven measures per day and platform for every day of the range, in one job.

    Leaves out one status and full refunds; turnover counts the discounted value. ``dt`` leads as
    the partition day; the rest is the exported schema. Distinct counts stay exact. They group
    on (day, platform, value) before (day, platform), so a platform with a third of all orders
    is spread over its values and folded on the map side first.
    """
    rows = in_days(orders, "created_at", start, end)
    rows = exclude_full_refunds(exclude_status(rows, excluded_status))
    rows = rows.withColumn("dt", F.to_date("created_at"))
    grouped = rows.groupBy("dt", "platform").agg(
        *_measures(rows, day_text(F.max("created_at")).alias("date"), discounted=True))
    turnover = F.col("gmv_disc") + F.col("delivery_fee_revenue") + F.col("service_fee_revenue")
    return _as_doubles(grouped.withColumn("gtv", turnover))


def financial_monthly(orders: DataFrame, start: dt.date | str, end: dt.date | str,
                      excluded_status: int = CANCELLED) -> DataFrame:
    """Nine measures per month and platform for every month touched by the range, in one job.

    Leaves out one status only and turnover counts the undiscounted value, so this is not the sum
    of the daily rows. ``dt`` is the first day of the month.
    """
    rows = exclude_status(in_months(orders, "created_at", start, end), excluded_status)
    rows = rows.withColumn("dt", F.to_date(F.trunc("created_at", "month")))
    grouped = rows.groupBy("dt", "platform").agg(
        *_measures(rows, month_text(F.max("created_at")).alias("month"), discounted=False))
    turnover = F.col("gmv") + F.col("delivery_fee_revenue") + F.col("service_fee_revenue")
    return _as_doubles(grouped.withColumn("gtv", turnover))


def financial_month(orders: DataFrame, day: dt.date | str, excluded_status: int = CANCELLED) -> DataFrame:
    """The monthly aggregate of the month ``day`` lies in."""
    month = month_start(day)
    return financial_monthly(orders, month, month, excluded_status)


def raw_orders(orders: DataFrame, start: dt.date | str, end: dt.date | str | None = None) -> DataFrame:
    """Order rows of one day or a range as the partner reads them; nothing is left out."""
    rows = in_days(orders, "created_at", start, end or start)
    return rows.select(
        F.to_date("created_at").alias("dt"),
        "platform",
        second_text("created_at").alias("created_at"),
        "warehouse_id",
        "user_id",
        "order_id",
        "original_price",
        F.col("oi_price").alias("gmv_disc"),
        (F.col("original_price") - F.col("oi_price")).alias("incentives"),
        "delivery_fee_price",
        "service_fee_price",
        "status",
        F.coalesce("payment_id", F.lit("")).alias("payment_id"),
    )


def raw_refunds(refunds: DataFrame, start: dt.date | str, end: dt.date | str | None = None) -> DataFrame:
    """Refund rows of one day or a range, by the day the refund was created."""
    rows = in_days(refunds, "created_at", start, end or start)
    return rows.select(
        F.to_date("created_at").alias("dt"),
        second_text("created_at").alias("created_at"),
        F.col("id").alias("refund_id"),
        "idempotency_key",
        "order_id",
        "price",
        "reference",
        second_text("refunded_at").alias("refunded_at"),
        "response_data",
        "type",
        "uuid",
    )
