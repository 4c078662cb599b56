"""Registered queries: every operator over whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybridge.functions.jsontext import clean_nulls, json_scalar
from daybridge.functions.times import day_text, month_text, second_text
from daybridge.functions.xmltext import iso_text
from daybridge.operators import catalogue, filters, finance, ranges
from daybridge.operators.conform import conform, conform_losses, sanitize
from daybridge.plans.backfill import backfill
from daybridge.plans.datasets import DATASETS
from daybridge.plans.exports import export_days, export_financial, export_partner_events, export_snapshot
from daybridge.plans.landing import land_days, land_rows
from daybridge.session import few_listing_tasks, many_files, prepare, shared_folder
from daybridge.sinks.catalogue import catalogue_xml, catalogue_xml_lite
from daybridge.sinks.files import write_json
from daybridge.sinks.landing import land
from daybridge.sinks.partitions import file_batches, row_bytes, write_partition, write_split
from daybridge.sources.envelope import unwrap_envelope
from daybridge.sources.landed import landed_files, parse_log_lines, read_log_lines, read_wrapped_parquet
from daybridge.sources.scans import snapshot, table_scan
from bridgecheck.views import AGENT, APP, table, view

Query = Callable[[SparkSession, str], DataFrame]

# The test tables span these days; the ranges below cover them whole.
FIRST, LAST = "1990-01-01", "2030-12-31"
DAY, MONTH = "1995-03-15", "1995-03-15"
EVENT_FIRST, EVENT_LAST = "2024-01-01", "2024-01-31"

QUERIES: dict[str, Query] = {}


def registered(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(prepare(spark), sf_dir)
    run.__name__, run.__doc__ = query.__name__, query.__doc__
    QUERIES[query.__name__] = run
    return query


def _orders(spark, sf_dir):
    return view(spark, sf_dir, "mart_orders")


def _text_dates(df: DataFrame) -> DataFrame:
    """Dates as text: the form compares the same on both sides."""
    return df.select(*[F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.DateType)
                       else second_text(f.name).alias(f.name)
                       if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) else F.col(f.name)
                       for f in df.schema])


def _money_as_double(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
                       else F.col(f.name) for f in df.schema])


def _order_rows(df: DataFrame) -> DataFrame:
    return _text_dates(_money_as_double(df))


# --- aggregates -------------------------------------------------------------------------------

@registered
def financial_daily(spark, sf_dir):
    return _text_dates(finance.financial_daily(_orders(spark, sf_dir), FIRST, LAST))


@registered
def financial_monthly(spark, sf_dir):
    return _text_dates(finance.financial_monthly(_orders(spark, sf_dir), FIRST, LAST))


@registered
def financial_month(spark, sf_dir):
    return _text_dates(finance.financial_month(_orders(spark, sf_dir), MONTH))


@registered
def raw_orders(spark, sf_dir):
    return _order_rows(finance.raw_orders(_orders(spark, sf_dir), FIRST, LAST))


@registered
def raw_refunds(spark, sf_dir):
    return _order_rows(finance.raw_refunds(view(spark, sf_dir, "refunds"), FIRST, LAST))


# --- scans and filters ------------------------------------------------------------------------

@registered
def table_scan_predicate(spark, sf_dir):
    return _text_dates(table_scan(table(spark, sf_dir, "lineitem"), "l_returnflag <> 'N' AND l_quantity > 10"))


@registered
def snapshot_scan(spark, sf_dir):
    return _text_dates(snapshot(table(spark, sf_dir, "supplier"), "2026-01-05"))


@registered
def on_day(spark, sf_dir):
    return _order_rows(filters.on_day(_orders(spark, sf_dir), "created_at", DAY))


@registered
def on_day_events(spark, sf_dir):
    return _text_dates(filters.on_day(table(spark, sf_dir, "events"), "ts", "2024-01-15"))


@registered
def in_month(spark, sf_dir):
    return _order_rows(filters.in_month(_orders(spark, sf_dir), "created_at", MONTH))


@registered
def exclude_status(spark, sf_dir):
    return _order_rows(filters.exclude_status(_orders(spark, sf_dir)))


@registered
def exclude_full_refunds(spark, sf_dir):
    return _order_rows(filters.exclude_full_refunds(_orders(spark, sf_dir)))


@registered
def partner_events(spark, sf_dir):
    events = view(spark, sf_dir, "analytics_events")
    return _text_dates(filters.partner_events(events, EVENT_FIRST, AGENT, APP, EVENT_LAST))


# --- scalar functions -------------------------------------------------------------------------

@registered
def json_extract_scalar(spark, sf_dir):
    events = view(spark, sf_dir, "analytics_events")
    return events.select("event_id", *[json_scalar("event_properties", k).alias(k)
                                       for k in ("user_agent", "currentApp", "session", "k")])


@registered
def time_formats(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", day_text("ts").alias("day"), month_text("ts").alias("month"),
                         second_text("ts").alias("second"),
                         iso_text(F.col("ts"), events.schema["ts"].dataType).alias("iso"))


@registered
def json_null_cleaning(spark, sf_dir):
    lines = view(spark, sf_dir, "log_lines")
    return lines.select("event_id", clean_nulls("line").alias("cleaned"))


# --- schema conformance -----------------------------------------------------------------------

def _cancelled(spark, sf_dir, as_array: bool) -> DataFrame:
    item = ("named_struct('quantity', l_quantity, 'id', l_partkey, 'name', l_returnflag, "
            "'price', l_extendedprice, 'tax', l_tax)")
    cart = f"array({item}, {item})" if as_array else item
    return table(spark, sf_dir, "lineitem").selectExpr(
        f"{cart} AS cart", "CAST(l_orderkey AS STRING) AS order_id", "l_suppkey AS user_id",
        "l_shipdate AS order_creation_time", "l_linenumber AS min_promised_delivery_time",
        "l_linestatus AS currency", "l_discount AS not_declared")


def _flat(df: DataFrame, item: str) -> DataFrame:
    return _text_dates(df.select(
        "order_id", "user_id", "order_creation_time", "min_promised_delivery_time", "currency", "cancel_reason",
        *[F.col(f"{item}.{n}").alias(f"item_{n}") for n in ("name", "id", "price", "original_price", "quantity")]))


@registered
def conform_struct(spark, sf_dir):
    schema = DATASETS["cancelled_orders"].schema(nested_as="struct")
    return _flat(conform(_cancelled(spark, sf_dir, False), schema), "cart")


@registered
def conform_array(spark, sf_dir):
    done = conform(_cancelled(spark, sf_dir, True), DATASETS["cancelled_orders"].schema())
    return _flat(done.withColumn("item", F.explode("cart")), "item")


def _odd_parts(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS id", "p_name AS name", "p_type AS weight", "CAST(p_size AS STRING) AS max_quantity",
        "CASE WHEN p_size > 25 THEN 'true' WHEN p_size > 10 THEN 'no idea' END AS is_active", "p_retailprice AS depth")


@registered
def conform_permissive(spark, sf_dir):
    done = conform(_odd_parts(spark, sf_dir), DATASETS["product_catalogue"].schema(), "permissive")
    return done.select("id", "name", "weight", "max_quantity", "is_active", "depth", "brand_name")


@registered
def conform_nulled(spark, sf_dir):
    return conform_losses(_odd_parts(spark, sf_dir), DATASETS["product_catalogue"].schema())


@registered
def sanitize_untyped(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", F.lit(None).alias("untyped"), F.array(F.lit(None)).alias("items"))
    done = conform(parts, sanitize(parts.schema))
    return done.select("p_partkey", "untyped", F.typeof("untyped").alias("untyped_type"),
                       F.size("items").cast("long").alias("items_size"), F.typeof("items").alias("items_type"))


# --- ranges -----------------------------------------------------------------------------------

@registered
def day_spine(spark, sf_dir):
    return _text_dates(ranges.spine_of(table(spark, sf_dir, "orders"), "o_orderdate"))


@registered
def month_spine(spark, sf_dir):
    return _text_dates(ranges.spine_of(table(spark, sf_dir, "orders"), "o_orderdate", "month"))


@registered
def range_report(spark, sf_dir):
    daily = finance.financial_daily(_orders(spark, sf_dir), FIRST, LAST)
    return _text_dates(ranges.range_report(daily, ranges.spine_of(table(spark, sf_dir, "orders"), "o_orderdate")))


@registered
def backfill_months(spark, sf_dir):
    """Export of every month as one job, then the outcome per month."""
    path = shared_folder(spark)
    orders = _orders(spark, sf_dir)
    bounds = orders.agg(F.min("created_at").alias("a"), F.max("created_at").alias("b")).first()
    done = backfill(spark, lambda a, b: export_financial(orders, "financial_monthly", path, a, b),
                    bounds.a, bounds.b, step="month")
    return _text_dates(done.select("period", "rows", "status"))


# --- sinks ------------------------------------------------------------------------------------

def _event_rows(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("dt", F.to_date("ts"))


def _read_back(spark, path: str) -> DataFrame:
    return _text_dates(spark.read.parquet(path))


@registered
def partition_replace(spark, sf_dir):
    """Two loads of all days, the second without the views, then what the table holds."""
    path = shared_folder(spark)
    spine = ranges.day_spine(spark, EVENT_FIRST, EVENT_LAST)
    write_partition(_event_rows(spark, sf_dir), path, spine=spine)
    write_partition(_event_rows(spark, sf_dir).where("event_type <> 'view'"), path, spine=spine)
    return _read_back(spark, path)


@registered
def partition_append(spark, sf_dir):
    """The whole supplier table appended twice to the folder of one day."""
    path = shared_folder(spark)
    rows = snapshot(table(spark, sf_dir, "supplier"), "2026-01-05")
    spine = ranges.day_spine(spark, "2026-01-05", "2026-01-05")
    write_partition(rows, path, mode="append", spine=spine)
    write_partition(rows, path, mode="append", spine=spine)
    return _read_back(spark, path)


@registered
def partition_report(spark, sf_dir):
    spine = ranges.day_spine(spark, EVENT_FIRST, EVENT_LAST)
    return _text_dates(write_partition(_event_rows(spark, sf_dir), shared_folder(spark), spine=spine))


@registered
def size_bounded_split(spark, sf_dir):
    path = shared_folder(spark)
    write_split(_event_rows(spark, sf_dir), path, 16 * 1024, spine=ranges.day_spine(spark, EVENT_FIRST, EVENT_LAST))
    return _read_back(spark, path)


@registered
def split_file_sizes(spark, sf_dir):
    """Short and very long texts split into files of 32 KiB: what lies above is one row of that size."""
    path, limit = shared_folder(spark), 32 * 1024
    rows = table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "text", "date_add(DATE '2026-01-01', CAST(coalesce(pmod(doc_id, 3), 0) AS INT)) AS dt")
    write_split(rows, path, limit)
    found = []
    for names in file_batches(spark, path):
        with many_files(spark):
            files = spark.read.schema(rows.schema).option("basePath", path).parquet(*names).select(
                "dt", F.col("_metadata.file_path").alias("file"), row_bytes(rows.schema).alias("bytes"))
            files = files.groupBy("dt", "file").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
            found += files.groupBy("dt").agg(
                F.sum("n").alias("documents"), F.sum("bytes").alias("total_bytes"),
                F.count_if(F.col("bytes") > limit).alias("files_above"),
                F.count_if((F.col("bytes") > limit) & (F.col("n") > 1)).alias("crowded_above")).collect()
            del files  # or its listing would be held while the next one is made
    sums = ("documents", "total_bytes", "files_above", "crowded_above")
    per_batch = spark.createDataFrame(found, f"dt date, {', '.join(f'{c} long' for c in sums)}")
    return _text_dates(per_batch.groupBy("dt").agg(*[F.sum(c).alias(c) for c in sums]))


@registered
def json_export(spark, sf_dir):
    path = shared_folder(spark)
    events = table(spark, sf_dir, "documents")
    write_json(events, path)
    return spark.read.schema(events.schema).json(path)


@registered
def export_partner_day_files(spark, sf_dir):
    """Filter, conform and split the partner's events of every day, then read the table."""
    path = shared_folder(spark)
    export_partner_events(view(spark, sf_dir, "analytics_events"), path, EVENT_FIRST, EVENT_LAST, AGENT, APP,
                          max_bytes=5 * 1024 * 1024)
    done = spark.read.parquet(path)
    return _text_dates(done.select("dt", "event_id", "event_time", "event_properties", "adid", "uuid"))


@registered
def export_day_range(spark, sf_dir):
    """Scan, day filter, conform and replace for every day at once, then read the table."""
    path = shared_folder(spark)
    source = table(spark, sf_dir, "events").selectExpr(
        "event_id AS id", "ts AS created_at", "user_id AS created_by", "value AS quantity", "event_type AS launch_id",
        "props AS not_declared")
    export_days(source, "operations", path, EVENT_FIRST, EVENT_LAST)
    done = spark.read.parquet(path)
    return _text_dates(done.select("dt", "id", "created_at", "created_by", "quantity", "launch_id", "is_deleted"))


@registered
def backfill_failing_days(spark, sf_dir):
    """Every day exported twice, the second time with values that do not fit on some days: those are reported and keep
    their rows of the first time, the others have the new ones. Per day the report and what the table holds."""
    path = shared_folder(spark)
    events = table(spark, sf_dir, "events")
    source = events.selectExpr(
        "event_id AS id", "ts AS created_at", "user_id AS created_by", "event_type AS launch_id",
        "CASE WHEN day(ts) % 5 = 2 AND event_id % 3 = 1 THEN 'many' ELSE CAST(event_id AS STRING) END AS quantity")
    export_days(source.where("launch_id = 'view'").withColumn("quantity", F.lit(1)), "operations", path, EVENT_FIRST, EVENT_LAST)
    done = backfill(spark, lambda a, b: export_days(source, "operations", path, a, b, cast_mode="isolate"),
                    EVENT_FIRST, EVENT_LAST, raise_on_failure=False)
    held = spark.read.parquet(path).groupBy(F.col("dt").alias("period")).agg(
        F.count("*").alias("held"), F.sum("quantity").alias("quantity"))
    return _text_dates(done.join(held, "period", "left").select("period", "rows", "status", "error", "held", "quantity"))


@registered
def export_catalogue_snapshot(spark, sf_dir):
    path = shared_folder(spark)
    parts = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS id", "p_name AS name", "p_brand AS brand_name", "p_size AS weight", "p_retailprice AS depth")
    export_snapshot(parts, "product_catalogue", path, "2026-01-05")
    done = spark.read.parquet(path)
    return _text_dates(done.select("dt", "id", "name", "brand_name", "weight", "depth", "country"))


# --- landing ----------------------------------------------------------------------------------

def _write_logs(spark, sf_dir) -> str:
    """The log lines as gzip text below one folder per day."""
    path = shared_folder(spark)
    lines = view(spark, sf_dir, "log_lines").select(F.to_date("ts").alias("dt"), F.col("line").alias("value"))
    lines.hint("rebalance", "dt").write.partitionBy("dt").option("compression", "gzip").text(path)
    return path


@registered
def landed_log_files(spark, sf_dir):
    files = landed_files(spark, _write_logs(spark, sf_dir), pattern="*.txt.gz")
    return _text_dates(files.groupBy("dt").agg((F.min("length") > 0).alias("has_bytes")))


@registered
def log_line_scan(spark, sf_dir):
    lines = read_log_lines(spark, _write_logs(spark, sf_dir), pattern="*.txt.gz")
    return _text_dates(lines.select("dt", "line"))


@registered
def log_records(spark, sf_dir):
    parsed = parse_log_lines(read_log_lines(spark, _write_logs(spark, sf_dir), pattern="*.txt.gz"))
    return _text_dates(parsed.select("dt", "record", "error"))


@registered
def log_records_by_file(spark, sf_dir):
    """Log files of which damaged ones would be rejected by themselves."""
    lines = read_log_lines(spark, _write_logs(spark, sf_dir), pattern="*.txt.gz", unreadable="reject")
    return parse_log_lines(lines).select("record", "error")


@registered
def log_records_of_texts(spark, sf_dir):
    """Log lines that carry whole documents, some with the word null in their text, read back from their records."""
    path = shared_folder(spark)
    (table(spark, sf_dir, "documents").selectExpr("doc_id", "concat_ws(' null ', text, source) AS text", "lang", "source")
     .select(F.to_json(F.struct("doc_id", "text", "lang", "source"), {"ignoreNullFields": "false"}).alias("value"))
     .write.option("compression", "gzip").text(path))
    record = parse_log_lines(read_log_lines(spark, path, pattern="*.txt.gz"))
    return record.select(json_scalar("record", "doc_id").cast("long").alias("doc_id"),
                         *[json_scalar("record", c).alias(c) for c in ("text", "lang", "source")], "error")


@registered
def land_log_records(spark, sf_dir):
    parsed = parse_log_lines(read_log_lines(spark, _write_logs(spark, sf_dir), pattern="*.txt.gz"))
    path = shared_folder(spark)
    land(parsed.where("error IS NULL"), path)
    return _text_dates(spark.read.parquet(path).select(
        "dt", "raw_data", "created_at", (F.length("id") == 36).alias("has_id")))


@registered
def land_table_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").selectExpr(
        "*", "CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS note", "CASE WHEN c_custkey % 2 = 0 THEN "
        "CAST('NaN' AS DOUBLE) ELSE c_acctbal END AS score")
    path = shared_folder(spark)
    land_rows(rows, path, "2026-01-05")
    return _text_dates(spark.read.parquet(path).select("dt", "raw_data", "created_at"))


def _write_wrapped(rows: DataFrame, path: str, damaged: bool = False) -> None:
    """Rows as gzip-wrapped Parquet files in the folder of their day, each written by a task."""
    def write(batches):
        import gzip
        import io
        import uuid

        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(path) if "://" in path else (
            fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/"))
        for batch in batches:
            whole = pa.Table.from_batches([batch])
            for day in set(whole.column("dt").to_pylist()):
                part = whole.filter(pc.equal(whole.column("dt"), day)).drop_columns("dt")
                sink = io.BytesIO()
                pq.write_table(part, sink)
                packed = gzip.compress(sink.getvalue(), 1)
                store.create_dir(f"{root}/{day}", recursive=True)
                name = uuid.uuid5(uuid.NAMESPACE_OID, sink.getvalue().hex())  # a retried task replaces its file
                with store.open_output_stream(f"{root}/{day}/{name}.parquet.gz", compression=None) as out:
                    out.write(packed[:len(packed) // 2] if damaged else packed)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    rows.mapInArrow(write, "n long").write.format("noop").mode("overwrite").save()


@registered
def wrapped_parquet(spark, sf_dir):
    path = shared_folder(spark)
    _write_wrapped(table(spark, sf_dir, "customer").withColumn("dt", F.lit(dt.date(2026, 1, 1))), path)
    schema = T.StructType.fromDDL(
        "c_name STRING, c_custkey BIGINT, c_nationkey BIGINT, c_acctbal DOUBLE, c_comment STRING")
    return read_wrapped_parquet(spark, path, schema).drop("source_file", "source_bytes", "dt")


@registered
def wrapped_parquet_files(spark, sf_dir):
    """Day folders of wrapped Parquet: sound files, files with narrower keys, and one that is damaged."""
    path = shared_folder(spark)
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "c_name", "c_acctbal", "date_add(DATE '2026-01-01', CAST(c_custkey % 3 AS INT)) AS dt")
    _write_wrapped(rows.where("c_custkey % 2 = 0"), path)
    _write_wrapped(rows.where("c_custkey % 2 = 1").withColumn("c_custkey", F.col("c_custkey").cast("int")), path)
    regions = table(spark, sf_dir, "region").selectExpr(
        "r_regionkey AS c_custkey", "r_name AS c_name", "0D AS c_acctbal", "DATE '2026-01-02' AS dt")
    _write_wrapped(regions.coalesce(1), path, damaged=True)
    schema = T.StructType.fromDDL("c_name STRING, c_custkey BIGINT, c_acctbal DOUBLE")
    found = read_wrapped_parquet(spark, path, schema)
    return _text_dates(found.select("dt", "c_name", "c_custkey", "c_acctbal", F.isnotnull("error").alias("is_damaged")))


@registered
def api_envelope(spark, sf_dir):
    return unwrap_envelope(view(spark, sf_dir, "responses"), "body", on_error="reject")


TURNS = 50


@registered
def api_envelope_of_turns(spark, sf_dir):
    """Responses with some turns of a conversation as records; some lack the success field, some are bare lists.

    A response has at most ``TURNS`` turns, so no conversation makes a response, or a task, of its size.
    """
    turn = F.struct("turn", "role", "text")
    records = F.to_json(F.sort_array(F.collect_list(turn)), {"ignoreNullFields": "false"})
    body = (F.when(F.col("conv_id") % 3 == 0, F.concat(F.lit('{"success":true,"data":'), records, F.lit("}")))
            .when(F.col("conv_id") % 3 == 1, F.concat(F.lit('{"data":'), records, F.lit("}"))).otherwise(records))
    turns = table(spark, sf_dir, "conversations").withColumn("block", F.floor(F.monotonically_increasing_id() / TURNS))
    responses = turns.groupBy("conv_id", "block").agg(body.alias("body")).drop("block")
    found = unwrap_envelope(responses, "body", on_error="reject")
    return found.select("conv_id", json_scalar("record", "turn").cast("long").alias("turn"),
                        *[json_scalar("record", c).alias(c) for c in ("role", "text")], "error")


@registered
def land_api_records(spark, sf_dir):
    records = unwrap_envelope(view(spark, sf_dir, "responses"), "body", on_error="reject")
    path = shared_folder(spark)
    land(records.where("error IS NULL"), path, dt.datetime(2026, 1, 5, 10, 30), on_empty="error")
    return _text_dates(spark.read.parquet(path).select("dt", "raw_data", "created_at"))


# --- catalogue --------------------------------------------------------------------------------

@registered
def catalogue_offer_elements(spark, sf_dir):
    return catalogue.catalogue_offers(view(spark, sf_dir, "merchant_products"))


@registered
def catalogue_documents(spark, sf_dir):
    """All documents written as files, several for each merchant, and every line of them read back."""
    path = shared_folder(spark)
    catalogue_xml(view(spark, sf_dir, "merchant_products"), path, generated_at=dt.datetime(2026, 2, 2, 10, 0),
                  max_offers=20)
    with few_listing_tasks(spark):
        lines = spark.read.option("basePath", path).text(path)
    return lines.groupBy("mercant_id", F.col("value").alias("line")).agg(F.count("*").alias("n"))


@registered
def catalogue_envelopes(spark, sf_dir):
    """Whole documents' first and last lines: envelope, merchant, company."""
    offers = catalogue.catalogue_offers(view(spark, sf_dir, "merchant_products"))
    known = catalogue.merchants(offers, 1000)
    return known.select("mercant_id", "offers", "fragments",
                        catalogue.document_open(dt.datetime(2026, 2, 2, 10, 0)).alias("opening"))


@registered
def catalogue_small_document(spark, sf_dir):
    products = view(spark, sf_dir, "merchant_products")
    lines = catalogue.catalogue_lite(products, dt.datetime(2026, 2, 2, 10, 0), order_by="id", max_offers=1000)
    return lines.select("kind", "value")


@registered
def catalogue_brief_files(spark, sf_dir):
    """The brief document of all products written as files, and every line of them read back."""
    path = shared_folder(spark)
    catalogue_xml_lite(view(spark, sf_dir, "merchant_products"), path, dt.datetime(2026, 2, 2, 10, 0), order_by="id",
                       max_offers=1000)
    return spark.read.text(path).groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


# --- exports of every dataset -----------------------------------------------------------------

def _exported(spark, sf_dir, name: str, source: DataFrame, *columns: str) -> DataFrame:
    """The source exported over all its days or as one snapshot, and the columns read back."""
    path = shared_folder(spark)
    if DATASETS[name].day_column is None:
        export_snapshot(source, name, path, "2026-01-05")
    elif name in ("financial_daily", "financial_raw", "refunds_raw"):
        export_financial(source, name, path, EVENT_FIRST, EVENT_LAST)
    else:
        export_days(source, name, path, EVENT_FIRST, EVENT_LAST)
    return _text_dates(spark.read.parquet(path).select("dt", *columns))


@registered
def export_order_days(spark, sf_dir):
    """Orders with their items of sixteen fields, of which the source has five; an item may be NULL."""
    item = ("named_struct('price', value, 'product_id', user_id, 'product_name', event_type, 'scanned_at', ts, "
            "'more', event_id)")
    source = table(spark, sf_dir, "events").selectExpr(
        "event_id AS order_id", "ts AS created_at", "props AS address", "CAST(value AS STRING) AS weight",
        f"CASE WHEN event_id % 5 > 0 THEN array({item}, NULL) END AS order_items")
    done = _exported(spark, sf_dir, "orders", source, "order_id", "created_at", "address", "weight", "order_items")
    return done.select("dt", "order_id", "created_at", "address", "weight",
                       F.size("order_items").cast("long").alias("n_items"),
                       F.size(F.map_keys(F.from_json(F.to_json(F.expr("order_items[0]"), {"ignoreNullFields": "false"}),
                                                     "map<string, string>"))).cast("long").alias("n_fields"),
                       F.expr("order_items[0].price").alias("item_price"),
                       F.expr("order_items[0].product_id").alias("item_product"),
                       F.expr("order_items[0].product_name").alias("item_name"),
                       second_text(F.expr("order_items[0].scanned_at")).alias("item_scanned"))


@registered
def export_delivered_days(spark, sf_dir):
    source = table(spark, sf_dir, "events").selectExpr(
        "event_id AS order_id", "ts AS order_creation_time", "user_id", "event_type AS name",
        "array(named_struct('quantity', value, 'name', event_type, 'id', event_id)) AS delivered_products")
    done = _exported(spark, sf_dir, "delivered_orders", source, "order_id", "order_creation_time", "user_id", "name",
                     "delivered_products")
    return done.select("dt", "order_id", "order_creation_time", "user_id", "name", F.inline("delivered_products")) \
        .toDF("dt", "order_id", "order_creation_time", "user_id", "name", *[f"item_{n}" for n in (
            "name", "id", "price", "original_price", "quantity")])


@registered
def export_delivered_structs(spark, sf_dir):
    """The same export with single nested items: selected, conformed, written by day and read back."""
    source = table(spark, sf_dir, "events").selectExpr(
        "event_id AS order_id", "ts AS order_creation_time", "user_id", "event_type AS name",
        "named_struct('quantity', value, 'name', event_type, 'id', event_id) AS delivered_products")
    path = shared_folder(spark)
    export_days(source, "delivered_orders", path, EVENT_FIRST, EVENT_LAST, nested_as="struct")
    items = [F.col(f"delivered_products.{n}").alias(f"item_{n}") for n in ("name", "id", "price", "original_price", "quantity")]
    return _text_dates(spark.read.parquet(path).select("dt", "order_id", "order_creation_time", "user_id", "name", *items))


@registered
def export_batch_days(spark, sf_dir):
    source = table(spark, sf_dir, "events").selectExpr(
        "event_id AS id", "ts AS created_at", "ts AS updated_at", "event_type AS batch_type", "value AS latitude",
        "CAST(user_id AS STRING) AS warehouse_id")
    return _exported(spark, sf_dir, "batches", source, "id", "created_at", "updated_at", "batch_type", "latitude",
                     "warehouse_id", "launch_id")


@registered
def export_warehouse_products(spark, sf_dir):
    source = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS id", "p_retailprice AS price", "p_size AS quantity", "p_size > 25 AS is_active", "p_name AS launch_id")
    return _exported(spark, sf_dir, "warehouse_products", source, "id", "price", "quantity", "is_active", "launch_id")


@registered
def export_warehouse_products_hourly(spark, sf_dir):
    """Two loads within one day: the second is added to the first."""
    path = shared_folder(spark)
    for hour in (10, 11):
        source = table(spark, sf_dir, "part").selectExpr(
            "p_partkey AS id", "p_size AS quantity", "p_type AS feature_name",
            f"make_timestamp(2026, 1, 5, {hour}, 0, 0) AS catalog_updated_at")
        export_snapshot(source, "warehouse_products_hourly", path, "2026-01-05")
    return _text_dates(spark.read.parquet(path).select("dt", "id", "quantity", "feature_name", "catalog_updated_at"))


@registered
def export_warehouses(spark, sf_dir):
    """The warehouse catalogue, whose opening hours are times of day."""
    source = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS id", "s_name AS name", "s_nationkey AS city_id", "s_acctbal AS lat",
        "CASE WHEN s_suppkey % 3 > 0 THEN '08:30:00' END AS opens_at", "'23:15:00' AS closes_at")
    done = _exported(spark, sf_dir, "warehouse_catalogue", source, "id", "name", "city_id", "lat", "opens_at", "closes_at")
    return done.withColumns({c: F.col(c).cast("string") for c in ("opens_at", "closes_at")})


@registered
def export_financial_days(spark, sf_dir):
    return _exported(spark, sf_dir, "financial_daily", view(spark, sf_dir, "event_orders"), *[
        c for c in DATASETS["financial_daily"].schema().names])


@registered
def export_financial_raw(spark, sf_dir):
    return _exported(spark, sf_dir, "financial_raw", view(spark, sf_dir, "event_orders"),
                     *DATASETS["financial_raw"].schema().names)


@registered
def export_refunds_raw(spark, sf_dir):
    return _exported(spark, sf_dir, "refunds_raw", view(spark, sf_dir, "event_refunds"),
                     *DATASETS["refunds_raw"].schema().names)


@registered
def conform_nested_nulled(spark, sf_dir):
    """Losses counted for each field of the items."""
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "array(named_struct('id', CASE WHEN l_linenumber = 2 THEN l_returnflag ELSE CAST(l_partkey AS STRING) END, "
        "'quantity', l_quantity), NULL, named_struct('id', l_linestatus, 'quantity', NULL)) AS cart",
        "l_shipdate AS order_creation_time", "l_returnflag AS order_id")
    return conform_losses(rows, DATASETS["cancelled_orders"].schema())


@registered
def land_log_days(spark, sf_dir):
    """Every day folder of gzip logs in one job: the table's records and the rejected lines."""
    logs, path = _write_logs(spark, sf_dir), shared_folder(spark)
    hadoop = spark._jvm.org.apache.hadoop.fs
    store = hadoop.Path(logs).getFileSystem(spark._jsc.hadoopConfiguration())
    for file in store.globStatus(hadoop.Path(f"{logs}/dt=*/*.txt.gz")):  # Spark cannot choose the suffix
        old = file.getPath()
        folder = hadoop.Path(logs, old.getParent().getName().removeprefix("dt="))
        store.mkdirs(folder)
        store.rename(old, hadoop.Path(folder, old.getName().replace(".txt.gz", ".log.gz")))
    land_days(spark, logs, path, EVENT_FIRST, EVENT_LAST)
    landed = spark.read.parquet(path).select("dt", F.col("raw_data").alias("text"), F.lit(None).cast("string").alias("error"))
    rejected = spark.read.parquet(f"{path}_rejects").select("dt", F.col("line").alias("text"), "error")
    return _text_dates(landed.unionByName(rejected))
