"""Input views over the test tables, as expressions valid both in Spark and in the check SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AGENT = "PartnerApp"
APP = "partnerMini"

_FULL = ("CAST(CAST(o_totalprice AS DECIMAL(18,2)) - CAST(o_orderkey % 50 AS DECIMAL(18,2))"
         " + CAST(o_orderkey % 7 AS DECIMAL(18,2)) + CAST(o_orderkey % 3 AS DECIMAL(18,2)) AS DECIMAL(18,2))")

_E = "CAST(event_id AS STRING)"
_C = "CAST(c_custkey AS STRING)"

VIEWS: dict[str, tuple[str, dict[str, str]]] = {
    "mart_orders": ("orders", {
        "platform": "o_orderpriority",
        "created_at": "o_orderdate",
        "warehouse_id": "o_custkey % 25",
        "user_id": "o_custkey",
        "order_id": "o_orderkey",
        "original_price": "CAST(o_totalprice AS DECIMAL(18,2))",
        "oi_price": "CAST(CAST(o_totalprice AS DECIMAL(18,2)) - CAST(o_orderkey % 50 AS DECIMAL(18,2)) AS DECIMAL(18,2))",
        "delivery_fee_price": "CAST(o_orderkey % 7 AS DECIMAL(18,2))",
        "service_fee_price": "CAST(o_orderkey % 3 AS DECIMAL(18,2))",
        "refund_amount": ("CASE WHEN o_orderkey % 10 = 0 THEN NULL "
                          f"WHEN o_orderkey % 10 = 1 THEN {_FULL} ELSE CAST(0 AS DECIMAL(18,2)) END"),
        "status": ("CAST(CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 8 "
                   "WHEN o_orderstatus = 'O' THEN 1 ELSE 2 END AS BIGINT)"),
        "payment_id": "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderkey AS STRING) END",
    }),
    "refunds": ("orders", {
        "created_at": "o_orderdate",
        "id": "o_orderkey",
        "idempotency_key": "'key-' || CAST(o_orderkey AS STRING)",
        "order_id": "o_orderkey",
        "price": _FULL,
        "reference": "o_custkey",
        "refunded_at": "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderdate END",
        "response_data": "'{\"status\":\"' || o_orderstatus || '\"}'",
        "type": "o_orderkey % 2",
        "uuid": "'u-' || CAST(o_custkey AS STRING)",
    }),
    "analytics_events": ("events", {
        "event_id": "event_id",
        "event_time": "ts",
        "event_type": "event_type",
        "event_properties": (
            "CASE event_id % 9 "
            f"WHEN 0 THEN '{{\"user_agent\":\"Mozilla PARTNERAPP/1.2\",\"session\":' || {_E} || '}}' "
            "WHEN 1 THEN '{\"user_agent\":\"Other/2\",\"currentApp\":\"x\"}' "
            "WHEN 2 THEN '{\"currentApp\":\"partnerMini\"}' "
            "WHEN 3 THEN '{\"user_agent\":{\"name\":\"partnerapp\"}}' "
            "WHEN 4 THEN '{\"user_agent\":null,\"currentApp\":[\"partnerMini\"]}' "
            "WHEN 5 THEN props "
            "WHEN 6 THEN '{\"user_agent\":\"partnerapp' "
            "WHEN 7 THEN '{\"user_agent\":\"' || chr(92) || 'u0070artnerapp\"}' "
            "ELSE NULL END"),
        "value": "value",
    }),
    "merchant_products": ("part", {
        "mercant_id": "CASE WHEN p_partkey % 50 = 0 THEN NULL WHEN p_partkey % 50 = 1 THEN '' ELSE p_brand END",
        "mercant_name": "p_brand || ' & Co'",
        "product_id": "p_partkey",
        "id": "p_partkey",
        "title": "CASE WHEN p_partkey % 7 = 0 THEN p_name || ' <new> & \"best\"' ELSE p_name END",
        "url": "'https://shop.example/p?id=' || CAST(p_partkey AS STRING) || '&lang=en'",
        "price": "p_retailprice",
        "original_price": "CASE WHEN p_partkey % 3 = 0 THEN p_retailprice + 1 ELSE NULL END",
        "category_full_path": "p_type || '>' || p_brand",
        "sub_category": "p_type",
        "url_picture": "CASE WHEN p_partkey % 4 = 0 THEN '' ELSE 'https://img.example/' || CAST(p_partkey AS STRING) END",
        "time_scrap": "CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE '2026-02-02T10:00:00' END",
        "measure": "CAST(p_size AS STRING)",
        "pars_date_created_at": "make_timestamp(2026, 2, CAST(1 + p_partkey % 3 AS INT), 0, 0, 0)",
    }),
    "log_lines": ("events", {
        "event_id": "event_id",
        "ts": "ts",
        "line": (
            "CASE event_id % 8 "
            f"WHEN 0 THEN '{{\"id\":' || {_E} || ',\"v\":null,\"note\":\"null NaN\"}}' "
            f"WHEN 1 THEN '{{\"id\":' || {_E} || ',\"xs\":[1,NaN,{{\"a\":null}}]}}' "
            "WHEN 2 THEN '   ' "
            f"WHEN 3 THEN '{{\"id\":' || {_E} "
            f"WHEN 4 THEN '{{\"id\":' || {_E} || '}} tail' "
            f"WHEN 5 THEN '  {{\"id\":' || {_E} || ',\"p\":' || props || '}}  ' "
            "WHEN 6 THEN 'null' "
            f"ELSE '{{\"id\":' || {_E} || ',\"t\":\"' || event_type || '\"}}' END"),
        "record": (
            "CASE event_id % 8 "
            f"WHEN 0 THEN '{{\"id\":' || {_E} || ',\"v\":\"\",\"note\":\"null NaN\"}}' "
            f"WHEN 1 THEN '{{\"id\":' || {_E} || ',\"xs\":[1,\"\",{{\"a\":\"\"}}]}}' "
            f"WHEN 5 THEN '{{\"id\":' || {_E} || ',\"p\":' || props || '}}' "
            "WHEN 6 THEN '\"\"' "
            f"WHEN 7 THEN '{{\"id\":' || {_E} || ',\"t\":\"' || event_type || '\"}}' "
            "ELSE NULL END"),
    }),
    "responses": ("customer", {
        "c_custkey": "c_custkey",
        "body": (
            "CASE c_custkey % 8 "
            f"WHEN 0 THEN '{{\"success\":true,\"data\":[{{\"id\":' || {_C} || ',\"v\":null}},{{\"id\":' || {_C} || '}}]}}' "
            f"WHEN 1 THEN '[{{\"id\":' || {_C} || '}}]' "
            "WHEN 2 THEN '{\"success\":false,\"error\":\"nope\",\"data\":[1]}' "
            f"WHEN 3 THEN '{{\"data\":[{{\"id\":' || {_C} || '}}]}}' "
            "WHEN 4 THEN '{\"success\":true}' "
            "WHEN 5 THEN '{\"success\":true,\"data\":{\"id\":1}}' "
            "WHEN 6 THEN '{\"success\":0,\"data\":[{\"id\":1}]}' "
            "ELSE '{\"success\":true,\"data\":[]}' END"),
    }),
    "event_orders": ("events", {
        "platform": "event_type",
        "created_at": "ts",
        "warehouse_id": "user_id % 25",
        "user_id": "user_id",
        "order_id": "event_id",
        "original_price": "CAST(event_id % 977 AS DECIMAL(18,2))",
        "oi_price": "CAST(event_id % 977 - event_id % 5 AS DECIMAL(18,2))",
        "delivery_fee_price": "CAST(event_id % 7 AS DECIMAL(18,2))",
        "service_fee_price": "CAST(event_id % 3 AS DECIMAL(18,2))",
        "refund_amount": ("CAST(CASE WHEN event_id % 10 = 1 THEN event_id % 977 - event_id % 5 + event_id % 7 + event_id % 3 "
                          "ELSE 0 END AS DECIMAL(18,2))"),
        "status": "CASE WHEN event_type = 'view' AND event_id % 4 = 0 THEN CAST(8 AS BIGINT) ELSE CAST(1 AS BIGINT) END",
        "payment_id": "CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(event_id AS STRING) END",
    }),
    "event_refunds": ("events", {
        "created_at": "ts",
        "id": "event_id",
        "idempotency_key": "'key-' || CAST(event_id AS STRING)",
        "order_id": "event_id",
        "price": "CAST(event_id % 977 AS DECIMAL(18,2))",
        "reference": "user_id",
        "refunded_at": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE ts END",
        "response_data": "props",
        "type": "event_id % 2",
        "uuid": "'u-' || CAST(user_id AS STRING)",
    }),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, columns = VIEWS[name]
    return table(spark, sf_dir, source).selectExpr(*[f"{expr} AS {alias}" for alias, expr in columns.items()])


def view_sql(name: str) -> str:
    source, columns = VIEWS[name]
    listed = ", ".join(f"{expr} AS {alias}" for alias, expr in columns.items())
    return f"{name} AS (SELECT {listed} FROM {source})"


def with_views(body: str, *names: str) -> str:
    """The check SQL with the named views in front."""
    return f"WITH {', '.join(view_sql(n) for n in names)} {body}"
