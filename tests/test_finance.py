import datetime as dt

import pytest
from pyspark.sql import functions as F

from daybridge.operators import filters, finance
from daybridge.operators.conform import conform
from daybridge.plans.datasets import DATASETS

COLUMNS = ("platform string, created_at timestamp, warehouse_id long, user_id long, order_id long, "
           "original_price double, oi_price double, delivery_fee_price double, service_fee_price double, "
           "refund_amount double, status long, payment_id string")


def at(text):
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame([
        ("app", at("2026-04-10 00:00:00"), 1, 10, 100, 50.0, 40.0, 3.0, 1.0, 0.0, 1, "p"),
        ("app", at("2026-04-10 23:59:59"), 1, 10, 101, 30.0, 30.0, 0.0, 1.0, 5.0, 2, None),
        ("app", at("2026-04-10 12:00:00"), 2, None, 101, 20.0, 15.0, 0.0, 0.0, 0.0, 1, "q"),
        (None, at("2026-04-10 05:00:00"), 2, 12, 102, 8.0, 8.0, 1.0, 1.0, 0.0, 1, "r"),
        ("app", at("2026-04-10 06:00:00"), 3, 13, 103, 99.0, 90.0, 2.0, 1.0, 93.0, 1, "full refund"),
        ("app", at("2026-04-10 06:00:00"), 3, 13, 104, 99.0, 90.0, 2.0, 1.0, 0.0, 8, "left out"),
        ("app", at("2026-04-10 06:00:00"), 3, 13, 105, 99.0, 90.0, 2.0, 1.0, 0.0, None, "no status"),
        ("app", at("2026-04-10 06:00:00"), 3, 13, 106, 99.0, 90.0, 2.0, 1.0, None, 1, "no refund amount"),
        ("app", at("2026-04-11 00:00:00"), 1, 10, 107, 10.0, 9.0, 0.0, 0.0, 0.0, 1, "s"),
        ("app", at("2026-05-01 00:00:00"), 1, 10, 108, 10.0, 9.0, 0.0, 0.0, 0.0, 1, "t"),
    ], COLUMNS)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_daily_measures(orders):
    found = finance.financial_daily(orders, "20260410", "2026-04-10")
    assert rows(found) == sorted([
        (dt.date(2026, 4, 10), "app", "2026.04.10", 2, 1, 2, 33.33, 100.0, 85.0, 15.0, 3.0, 2.0, 90.0),
        (dt.date(2026, 4, 10), None, "2026.04.10", 1, 1, 1, 8.0, 8.0, 8.0, 0.0, 1.0, 1.0, 10.0),
    ], key=str)


def test_daily_range_equals_days_one_by_one(orders):
    whole = rows(finance.financial_daily(orders, "2026-04-10", "2026-05-01"))
    single = [r for d in ("2026-04-10", "2026-04-11", "2026-05-01") for r in rows(finance.financial_daily(orders, d, d))]
    assert whole == sorted(single, key=str)


def test_monthly_keeps_refunds_and_counts_undiscounted_turnover(orders):
    found = {(r.dt, r.platform): r for r in finance.financial_monthly(orders, "2026-04-20", "2026-05-02").collect()}
    april = found[dt.date(2026, 4, 1), "app"]
    assert (april.month, april.orders, april.gmv, april.gtv) == ("2026.04.01", 5, 308.0, 308.0 + 7.0 + 4.0)
    assert "gmv_disc" not in april.asDict()
    assert found[dt.date(2026, 5, 1), "app"].orders == 1


def test_single_month_takes_the_month_of_any_day(orders):
    assert rows(finance.financial_month(orders, "2026-04-30")) == rows(
        finance.financial_monthly(orders, "2026-04-01", "2026-04-01"))


def test_raw_orders_keep_every_row(orders):
    found = finance.raw_orders(orders, "2026-04-10")
    assert found.count() == 8
    first = found.where("order_id = 100").first()
    assert (first.created_at, first.gmv_disc, first.incentives) == ("2026-04-10 00:00:00", 40.0, 10.0)
    assert found.where("payment_id = ''").count() == 1


def test_raw_refunds(spark):
    refunds = spark.createDataFrame(
        [(at("2026-04-10 10:00:00"), 1, "k", 5, 2.5, 7, None, "{}", 0, "u"),
         (None, 2, "k", 5, 2.5, 7, at("2026-04-10 10:00:00"), "{}", 0, "u")],
        "created_at timestamp, id long, idempotency_key string, order_id long, price double, reference long, "
        "refunded_at timestamp, response_data string, type long, uuid string")
    assert rows(finance.raw_refunds(refunds, "2026-04-10")) == [
        (dt.date(2026, 4, 10), "2026-04-10 10:00:00", 1, "k", 5, 2.5, 7, None, "{}", 0, "u")]


@pytest.mark.parametrize("name, found", [
    ("financial_daily", lambda o: finance.financial_daily(o, "2026-04-10", "2026-04-10")),
    ("financial_monthly", lambda o: finance.financial_month(o, "2026-04-10")),
    ("financial_raw", lambda o: finance.raw_orders(o, "2026-04-10")),
])
def test_columns_are_the_declared_ones(orders, name, found):
    declared = DATASETS[name].schema()
    assert found(orders).columns == ["dt", *declared.names]
    assert conform(found(orders), declared).dtypes == [(f.name, f.dataType.simpleString()) for f in declared]


def test_filters_drop_unknown(orders):
    assert {r.order_id for r in filters.exclude_status(orders).collect()}.isdisjoint({104, 105})
    kept = {r.order_id for r in filters.exclude_full_refunds(orders).collect()}
    assert 103 not in kept and 106 not in kept and 105 in kept


def test_day_and_month_bounds(orders):
    assert filters.on_day(orders, "created_at", "2026-04-11").count() == 1
    assert filters.in_month(orders, "created_at", "2026-04-17").count() == 9


def test_period_filters_reach_the_scan(spark, orders, folder, capsys):
    orders.write.mode("overwrite").parquet(f"{folder}/orders")
    stored = spark.read.parquet(f"{folder}/orders")
    finance.financial_daily(stored, "2026-04-10", "2026-04-12").explain("formatted")
    plan = capsys.readouterr().out
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    assert "GreaterThanOrEqual(created_at" in pushed and "LessThan(created_at" in pushed
    read = next(line for line in plan.splitlines() if line.startswith("ReadSchema"))
    assert "payment_id" not in read


def test_distinct_counts_spread_a_hot_platform(orders, capsys):
    finance.financial_daily(orders, "2026-04-10", "2026-04-12").explain()
    exchanges = [line for line in capsys.readouterr().out.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2
    assert "order_id" in exchanges[1] and "user_id" in exchanges[1]


def test_days_need_utc(spark, orders):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError, match="timeZone"):
            finance.financial_daily(orders, "2026-04-10", "2026-04-12")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


EVENTS = [
    (1, '{"user_agent":"X PartnerAPP/1"}', True),
    (2, '{"user_agent":"other","currentApp":"mini"}', True),
    (3, '{"user_agent":{"a":"partnerapp"}}', False),
    (4, '{"user_agent":["partnerapp"]}', False),
    (5, '{"note":"partnerapp"}', False),
    (6, '{"currentApp":"mini "}', False),
    (7, '{"user_agent":"\\u0050artnerapp"}', True),
    (8, '{"currentApp":"m\\u0069ni"}', True),
    (9, '{"user_agent":"partnerapp"', False),
    (10, None, False),
    (11, '{"user_agent":null,"currentApp":"mini"}', True),
    (12, '{"user_agent":{"a":1},"currentApp":"mini"}', True),
]


@pytest.mark.parametrize("agent", ["partnerapp", "PARTNERAPP"])
def test_partner_events(spark, agent):
    data = [(n, at("2026-04-10 10:00:00"), text) for n, text, _ in EVENTS] + [
        (99, at("2026-04-11 00:00:00"), EVENTS[0][1])]
    events = spark.createDataFrame(data, "event_id long, event_time timestamp, event_properties string")
    found = {r.event_id for r in filters.partner_events(events, "2026-04-10", agent, "mini").collect()}
    assert found == {n for n, _, wanted in EVENTS if wanted}
    both = filters.partner_events(events, "2026-04-10", agent, "mini", "2026-04-11")
    assert 99 in {r.event_id for r in both.collect()}


@pytest.mark.parametrize("sign", [1, -1])
def test_mean_is_rounded_once(spark, sign):
    """5,000 cents over 10,001 orders are 0.49995 cents: 0.00, where rounding at six digits first gives 0.01."""
    rows = spark.range(10_001).select(
        F.lit(dt.datetime(2026, 1, 5, tzinfo=dt.timezone.utc)).alias("created_at"), F.lit("web").alias("platform"),
        F.col("id").alias("order_id"), F.col("id").alias("user_id"), F.lit(1).alias("warehouse_id"), F.lit(1).alias("status"),
        F.when(F.col("id") < 5000, sign * 0.01).otherwise(0).cast("decimal(18,2)").alias("original_price"),
        *[F.lit(0).cast("decimal(18,2)").alias(c) for c in ("oi_price", "delivery_fee_price", "service_fee_price")],
        F.lit(1).cast("decimal(18,2)").alias("refund_amount"))
    assert finance.financial_daily(rows, "2026-01-05", "2026-01-05").first().aov == 0.0
    more = rows.withColumn("original_price", F.when(F.col("order_id") < 5001, sign * 0.01).otherwise(0).cast("decimal(18,2)"))
    assert finance.financial_daily(more, "2026-01-05", "2026-01-05").first().aov == sign * 0.01
