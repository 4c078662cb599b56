import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybridge.operators.conform import conform, conform_losses, sanitize
from daybridge.plans.datasets import DATASETS, spark_schema
from daybridge.plans.exports import export_days

DDL = T.StructType.fromDDL


def test_adds_drops_orders_and_casts(spark):
    df = spark.createDataFrame([("7", 1.9, "x")], "b string, a double, extra string")
    found = conform(df, DDL("a long, missing array<string>, b int"))
    assert found.dtypes == [("a", "bigint"), ("missing", "array<string>"), ("b", "int")]
    assert found.first() == (1, None, 7)


def test_strict_raises_and_permissive_counts(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,), ("y",)], "a string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(df, DDL("a long")).collect()
    assert [r.a for r in conform(df, DDL("a long"), "permissive").collect()] == [1, None, None, None]
    assert conform_losses(df, DDL("a long, b string")).collect() == [("a", 2)]


def test_strict_needs_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(ValueError, match="ansi"):
            conform(spark.range(1), DDL("id string"))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_struct_fields_pair_by_name(spark):
    df = spark.createDataFrame([((2.5, "n", 1),), (None,)], "s struct<price: double, name: string, other: int>")
    found = conform(df, DDL("s struct<name: string, id: long, price: long>"))
    assert [r.s for r in found.collect()] == [("n", None, 2), None]


def test_nested_lists(spark):
    df = spark.createDataFrame([([[(1, "7")], None],)], "x array<array<struct<a: int, b: string>>>")
    found = conform(df, DDL("x array<array<struct<b: long, c: string>>>")).first().x
    assert found == [[(7, None)], None]


def test_same_shape_is_one_cast(spark, capsys):
    df = spark.createDataFrame([([(1.5, "7")],)], "x array<struct<a: double, b: string>>")
    found = conform(df, DDL("x array<struct<a: long, b: long>>"))
    assert found.first().x == [(1, 7)]
    found.explain()
    assert "transform" not in capsys.readouterr().out


def test_list_is_no_struct(spark):
    df = spark.createDataFrame([([(1,)],)], "s array<struct<a: int>>")
    for mode in ("strict", "permissive"):
        with pytest.raises(TypeError, match="s: cannot turn array"):
            conform(df, DDL("s struct<a: int>"), mode)


def test_sanitize():
    schema = T.StructType([T.StructField("n", T.NullType(), False), T.StructField("l", T.ArrayType(T.NullType()), False),
                           T.StructField("i", T.IntegerType(), False)])
    assert sanitize(schema) == T.StructType([
        T.StructField("n", T.StringType(), True), T.StructField("l", T.ArrayType(T.StringType(), True), True),
        T.StructField("i", T.IntegerType(), True)])


@pytest.mark.parametrize("name", sorted(DATASETS))
def test_every_declared_schema_takes_a_source_of_its_own(spark, name, folder):
    declared = DATASETS[name].schema()
    empty = conform(spark.createDataFrame([(1,)], "unrelated int"), declared)
    empty.write.mode("overwrite").parquet(f"{folder}/t")
    assert spark.read.parquet(f"{folder}/t").schema == declared
    assert spark.read.parquet(f"{folder}/t").first().asDict() == dict.fromkeys(declared.names)


def test_times_survive(spark, folder):
    df = spark.createDataFrame([(1, "08:30:00")], "id long, opens_at string")
    conform(df, DATASETS["warehouse_catalogue"].schema()).write.mode("overwrite").parquet(f"{folder}/t")
    assert spark.read.parquet(f"{folder}/t").first().opens_at == dt.time(8, 30)


def test_declared_sizes():
    sizes = {name: len(d.schema()) for name, d in DATASETS.items()}
    assert sizes == {"analytics_events": 47, "batches": 13, "operations": 11, "orders": 47, "cancelled_orders": 18,
                     "delivered_orders": 15, "warehouse_products": 19, "warehouse_products_hourly": 21,
                     "product_catalogue": 38, "warehouse_catalogue": 26, "financial_daily": 12,
                     "financial_monthly": 10, "financial_raw": 12, "refunds_raw": 10}
    assert len(DATASETS["orders"].schema()["order_items"].dataType.elementType) == 16
    assert isinstance(DATASETS["orders"].schema("struct")["order_items"].dataType, T.StructType)


def test_warehouse_types(spark):
    fields = [
        {"name": "a", "type": "INT64", "mode": "REQUIRED"}, {"name": "b", "type": "NUMERIC"},
        {"name": "c", "type": "NUMERIC", "precision": 10, "scale": 0}, {"name": "d", "type": "BIGNUMERIC"},
        {"name": "e", "type": "BIGNUMERIC", "precision": 30, "scale": 5}, {"name": "f", "type": "INTERVAL"},
        {"name": "g", "type": "RECORD", "mode": "REPEATED", "fields": [{"name": "x", "type": "DATE"}]},
        {"name": "h", "type": "datetime"}, {"name": "i", "type": "JSON", "mode": "NULLABLE"},
        {"name": "j", "type": "TIME"}, {"name": "k", "type": "BYTES"}]
    found = spark_schema(fields)
    assert [f.dataType.simpleString() for f in found] == [
        "bigint", "decimal(38,9)", "decimal(10,0)", "string", "decimal(30,5)", "string", "array<struct<x:date>>",
        "timestamp_ntz", "string", "time(6)", "binary"]
    assert [f.nullable for f in found][:2] == [False, True]


def test_keep_and_case(spark):
    df = spark.createDataFrame([(1, 2)], "ID long, dt int")
    assert conform(df, DDL("ID long"), keep=("dt",)).columns == ["dt", "ID"]


def test_untyped_column(spark):
    df = spark.range(1).select(F.lit(None).alias("a"), F.array().alias("b"))
    found = conform(df, sanitize(df.schema))
    assert found.dtypes == [("a", "string"), ("b", "array<string>")]


def test_losses_of_nested_values(spark):
    df = spark.createDataFrame(
        [([("7", "1.5"), ("bad", "x"), None, ("worse", None)], ("q",), 1), (None, None, None), ([], ("2",), 2)],
        "cart array<struct<id: string, price: string>>, s struct<a: string>, n int")
    schema = DDL("cart array<struct<id: long, price: double, missing: long>>, s struct<a: long>, n long, other string")
    found = {r["column"]: r.nulled for r in conform_losses(df, schema).collect()}
    assert found == {"cart[].id": 2, "cart[].price": 1, "s.a": 1, "n": 0}
    assert {r.nulled for r in conform_losses(df.limit(0), schema).collect()} == {0}
    assert conform_losses(df, DDL("other string")).collect() == []
    deep = spark.createDataFrame([([["1", "x"], None, ["y"]],)], "l array<array<string>>")
    assert conform_losses(deep, DDL("l array<array<int>>")).collect() == [("l[][]", 2)]


def test_permissive_export_reports_its_losses(spark, folder, caplog):
    source = spark.createDataFrame(
        [(dt.datetime(2026, 1, 1, 10, tzinfo=dt.timezone.utc), [("x", 1)], "7"),
         (dt.datetime(2026, 1, 1, 11, tzinfo=dt.timezone.utc), [("8", 1), ("y", 2)], "no")],
        "order_creation_time timestamp, cart array<struct<id: string, quantity: int>>, order_id string")
    with caplog.at_level("WARNING", logger="daybridge.plans.exports"):
        export_days(source, "cancelled_orders", f"{folder}/t", "2026-01-01", "2026-01-01", cast_mode="permissive")
    assert "cart[].id: 2" in caplog.text and "order_id: 1" in caplog.text and "quantity" not in caplog.text
    assert spark.read.parquet(f"{folder}/t").count() == 2


def test_reordered_items_are_the_same_by_list_and_by_item(spark):
    """Lists of flat items are put together from their fields; NULL lists, NULL items and items of NULLs stay what they are."""
    source = spark.createDataFrame(
        [(1, [(1.0, "a", 7), (2.0, None, 8)]), (2, []), (3, None), (4, [None]), (5, [(3.0, "c", 9), None]),
         (6, [(None, None, None)]), (7, [(None, None, None), None, (4.0, "d", None)])],
        "id long, cart array<struct<price double, name string, extra int>>")
    schema = T.StructType.fromDDL("id long, cart array<struct<name string, id long, price long>>")
    found = {r.id: r.cart if r.cart is None else [i and tuple(i) for i in r.cart] for r in conform(source, schema).collect()}
    assert found == {1: [("a", None, 1), (None, None, 2)], 2: [], 3: None, 4: [None], 5: [("c", None, 3), None],
                     6: [(None, None, None)], 7: [(None, None, None), None, ("d", None, 4)]}
    assert conform(source, schema).schema["cart"].dataType == schema["cart"].dataType
    tight = spark.sql("SELECT 1L AS id, array(named_struct('price', 1D, 'name', 'a')) AS cart")
    assert [tuple(i) for i in conform(tight, schema).first().cart] == [("a", None, 1)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(spark.sql("SELECT 1L AS id, array(named_struct('price', 'many', 'name', 'a')) AS cart"), schema).collect()
    assert conform(spark.sql("SELECT 1L AS id, array(named_struct('price', 'many', 'name', 'a')) AS cart"), schema,
                   "permissive").first().cart[0].price is None
