"""Row filters: period, status, refunds, partner traffic."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybridge.functions.jsontext import any_scalar
from daybridge.functions.times import between_days, between_months
from daybridge.session import require

CANCELLED = 8  # fixed value: the order status left out of the aggregates


def _check_zone(df: DataFrame, column: str) -> None:
    """Days of a timestamp with zone are days of the session, which has to be UTC."""
    if isinstance(df.schema[column].dataType, T.TimestampType):
        require(df.sparkSession, "spark.sql.session.timeZone")


def in_days(df: DataFrame, column: str, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """Rows of whole days, both ends included."""
    _check_zone(df, column)
    return df.where(between_days(column, start, end))


def in_months(df: DataFrame, column: str, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """Rows of the whole months the two days lie in, and of those between."""
    _check_zone(df, column)
    return df.where(between_months(column, start, end))


def on_day(df: DataFrame, column: str, day: dt.date | str) -> DataFrame:
    return in_days(df, column, day, day)


def in_month(df: DataFrame, column: str, month: dt.date | str) -> DataFrame:
    """Rows of the month that holds ``month``, whichever of its days is given."""
    return in_months(df, column, month, month)


def exclude_status(df: DataFrame, code: int = CANCELLED) -> DataFrame:
    """Drop one status; a NULL status compares as unknown and is dropped too."""
    return df.where(F.col("status") != code)


def exclude_full_refunds(df: DataFrame) -> DataFrame:
    """Drop orders refunded in full; any NULL among the four amounts drops the row."""
    paid = F.col("oi_price") + F.col("delivery_fee_price") + F.col("service_fee_price")
    return df.where(F.col("refund_amount") != paid)


def from_partner(properties: str | Column, agent: str, app: str) -> Column:
    """True when the JSON names the partner's agent (any case, anywhere) or exactly its app.

    Parsing JSON is the cost here, so plain substring tests go first: a matching value without
    escapes shows up literally in the text, and any text with a backslash is parsed regardless.
    """
    text = F.col(properties) if isinstance(properties, str) else properties
    agent = agent.lower()
    matches = any_scalar(text, {
        "user_agent": lambda value: F.contains(F.lower(value), F.lit(agent)),
        "currentApp": lambda value: value == app,
    })
    # Lower-casing depends on the neighbouring letters only outside ASCII.
    if not agent.isascii():
        return matches
    may_match = (F.contains(F.lower(text), F.lit(agent)) | F.contains(text, F.lit(app))
                 | F.contains(text, F.lit("\\")))
    return may_match & matches


def partner_events(df: DataFrame, start: dt.date | str, agent: str, app: str,
                   end: dt.date | str | None = None) -> DataFrame:
    """Events of the partner on one day, or on every day up to ``end``."""
    return in_days(df, "event_time", start, end or start).where(from_partner("event_properties", agent, app))
