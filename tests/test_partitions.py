import datetime as dt
import glob
import os
import re

import pyarrow as pa
import pytest
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybridge.operators.ranges import day_spine, month_spine, range_report
from daybridge.plans.backfill import RangeFailed, backfill
from daybridge.plans.exports import export_days, export_financial, export_partner_events, export_snapshot
from daybridge.session import many_files
from daybridge.sinks.files import EmptyExport, write_json
from daybridge.sinks.partitions import arrow_bytes, row_bytes, write_partition, write_split

D = dt.date


def days(spark, *pairs):
    return spark.createDataFrame([(n, D.fromisoformat(d)) for n, d in pairs], "n long, dt date")


def table(spark, path):
    return sorted((r.n, r.dt.isoformat()) for r in spark.read.parquet(path).collect())


def report(df):
    return [tuple(r) for r in df.orderBy("period").collect()]


def test_spines(spark):
    assert [r.period for r in day_spine(spark, "20260227", "2026-03-01").collect()] == [
        D(2026, 2, 27), D(2026, 2, 28), D(2026, 3, 1)]
    assert [r.period for r in month_spine(spark, "2025-11-30", "2026-01-01").collect()] == [
        D(2025, 11, 1), D(2025, 12, 1), D(2026, 1, 1)]
    assert day_spine(spark, "2026-01-02", "2026-01-01").count() == 0
    assert month_spine(spark, "2026-02-01", "2026-01-31").count() == 0
    assert month_spine(spark, "2026-01-31", "2026-01-01").count() == 1


def test_range_report(spark):
    found = range_report(days(spark, (1, "2026-01-01"), (2, "2026-01-01")), day_spine(spark, "2026-01-01", "2026-01-02"))
    assert report(found) == [(D(2026, 1, 1), 2, "ok"), (D(2026, 1, 2), 0, "empty")]


def test_replace_keeps_other_days_and_clears_empty_ones(spark, folder):
    path = f"{folder}/t"
    write_partition(days(spark, (1, "2026-01-01"), (2, "2026-01-02"), (3, "2026-01-03"), (4, "2026-01-04")), path)
    found = write_partition(days(spark, (20, "2026-01-02"), (21, "2026-01-02")), path,
                            spine=day_spine(spark, "2026-01-02", "2026-01-03"))
    assert report(found) == [(D(2026, 1, 2), 2, "replaced"), (D(2026, 1, 3), 0, "empty")]
    assert table(spark, path) == [(1, "2026-01-01"), (4, "2026-01-04"), (20, "2026-01-02"), (21, "2026-01-02")]
    assert len(glob.glob(f"{path}/dt=2026-01-03/*.gz.parquet")) == 1


def test_empty_days_need_not_be_marked(spark, folder):
    path = f"{folder}/t"
    spine = day_spine(spark, "2026-01-01", "2026-01-04")
    assert write_partition(days(spark, (1, "2026-01-01")).where("n > 5"), path, spine=spine, mark_empty=False).count() == 4
    write_partition(days(spark, (1, "2026-01-01"), (2, "2026-01-02")), path)
    found = write_partition(days(spark, (3, "2026-01-03")), path, spine=spine, mark_empty=False)
    assert [r.status for r in found.orderBy("period").collect()] == ["empty", "empty", "replaced", "empty"]
    assert table(spark, path) == [(3, "2026-01-03")]
    assert not glob.glob(f"{path}/dt=2026-01-04")


def test_replace_with_no_rows_at_all(spark, folder):
    path = f"{folder}/t"
    write_partition(days(spark, (1, "2026-01-01")), path)
    spine = day_spine(spark, "2026-01-01", "2026-01-02")
    assert report(write_partition(days(spark, (1, "2026-01-01")).where("n > 5"), path, spine=spine)) == [
        (D(2026, 1, 1), 0, "empty"), (D(2026, 1, 2), 0, "empty")]
    assert table(spark, path) == []


def test_append_doubles(spark, folder):
    path, spine = f"{folder}/t", day_spine(spark, "2026-01-01", "2026-01-01")
    rows = days(spark, (1, "2026-01-01"))
    for _ in range(2):
        assert report(write_partition(rows, path, mode="append", spine=spine)) == [(D(2026, 1, 1), 1, "appended")]
    assert table(spark, path) == [(1, "2026-01-01")] * 2
    with pytest.raises(ValueError, match="spine"):
        write_partition(rows, path, mode="append")


def test_rows_outside_the_spine_fail_before_commit(spark, folder):
    path = f"{folder}/t"
    write_partition(days(spark, (1, "2026-01-01"), (5, "2026-01-05")), path)
    for bad in (D(2026, 1, 5), None):
        rows = spark.createDataFrame([(9, D(2026, 1, 1)), (9, bad)], "n long, dt date")
        with pytest.raises(Exception, match="dt outside the range to write"):
            write_partition(rows, path, spine=day_spine(spark, "2026-01-01", "2026-01-02"))
    assert table(spark, path) == [(1, "2026-01-01"), (5, "2026-01-05")]


def test_reversed_range_writes_nothing(spark, folder):
    spine = day_spine(spark, "2026-01-02", "2026-01-01")
    assert write_partition(days(spark, (1, "2026-01-01")), f"{folder}/t", spine=spine).count() == 0
    assert glob.glob(f"{folder}/*") == []


def test_one_large_day_is_cut_into_tasks_and_small_ones_are_not(spark, folder):
    rows = spark.range(400_000, numPartitions=16).select(
        F.sha2(F.col("id").cast("string"), 256).alias("s"),
        F.when(F.col("id") % 3 == 0, F.lit(D(2026, 1, 1))).otherwise(
            F.date_add(F.lit(D(2026, 1, 2)), (F.col("id") % 20).cast("int"))).alias("dt"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write_partition(rows, f"{folder}/t")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(f"{folder}/t/dt=2026-01-01/*.parquet")) > 3
    # 16 tasks hold rows of every day; without bringing them together each day had 16 files.
    assert len(glob.glob(f"{folder}/t/dt=2026-01-09/*.parquet")) < 8
    assert spark.read.parquet(f"{folder}/t").count() == 400_000


def test_arrow_bytes(spark):
    ddl = "a long, s string, b boolean, l array<string>, st struct<x: int, y: string>, d decimal(10,2), f float, t date"
    rows = [(i, "x" * (i % 50), True, ["ab"] * (i % 4), (i, "yy"), None, 1.0, D(2026, 1, 1)) for i in range(1000)]
    df = spark.createDataFrame(rows, ddl)
    size = sum((arrow_bytes(F.col(f.name), f.dataType) for f in df.schema), F.lit(0.0))
    estimate = df.select(F.sum(size).alias("n")).first().n
    table = df.toArrow()
    assert estimate == pytest.approx(pa.concat_tables([table]).combine_chunks().nbytes, rel=0.1)


def test_split_bounds_files(spark, folder):
    rows = spark.range(50_000, numPartitions=4).select(
        "id", F.repeat(F.lit("x"), 100).alias("s"), F.date_add(F.lit(D(2026, 1, 1)), (F.col("id") % 2).cast("int")).alias("dt"))
    limit = 256 * 1024
    write_split(rows, f"{folder}/t", limit, spine=day_spine(spark, "2026-01-01", "2026-01-02"))
    files = glob.glob(f"{folder}/t/dt=*/*.parquet")
    assert len(files) >= 50_000 * 112 / limit
    import pyarrow.parquet as pq
    assert max(pq.ParquetFile(f).read().nbytes for f in files) <= limit * 1.05
    assert spark.read.parquet(f"{folder}/t").distinct().count() == 50_000


def test_split_bounds_files_of_mixed_rows(spark, folder, caplog):
    """Narrow and wide rows of one day: no file above the bound but those of one row."""
    width = F.when(F.col("id") % 20 == 0, 9_000).when(F.col("id") == 77, 70_000).otherwise(F.col("id") % 90)
    rows = spark.range(4_000, numPartitions=5).withColumn("w", width.cast("int")).select(
        F.col("id").alias("part"), F.expr("repeat('x', w)").alias("bytes"), F.lit(D(2026, 1, 1)).alias("dt"))
    limit = 64 * 1024
    write_split(rows, f"{folder}/t", limit)
    import pyarrow.parquet as pq
    tables = [pq.ParquetFile(f).read() for f in glob.glob(f"{folder}/t/dt=*/*.parquet")]
    assert [t.num_rows for t in tables if t.nbytes > limit] == [1]
    total = sum(t.nbytes for t in tables)
    assert len(tables) <= 2 + total / (limit - 9_100)
    stored = spark.read.parquet(f"{folder}/t")
    assert stored.count() == 4_000 and stored.exceptAll(rows.select(*stored.columns)).isEmpty()
    assert "1 rows above" in caplog.text


def test_split_checks_its_arguments(spark, folder):
    rows = spark.createDataFrame([("x", D(2026, 1, 2))], "s string, dt date")
    with pytest.raises(ValueError, match="positive"):
        write_split(rows, f"{folder}/t", 0)
    with pytest.raises(Exception, match="outside the range"):
        write_split(rows, f"{folder}/t", 10, spine=day_spine(spark, "2026-01-03", "2026-01-04"))
    found = write_split(rows.limit(0), f"{folder}/t", 10, spine=day_spine(spark, "2026-01-03", "2026-01-04"))
    assert [r[2] for r in report(found)] == ["empty", "empty"]


@pytest.mark.parametrize("with_spine", [True, False])
def test_one_period_of_wide_rows_leaves_the_others_alone(spark, folder, with_spine):
    narrow = spark.range(20_000, numPartitions=2).select("id", F.lit("x").alias("s"), F.lit(D(2026, 1, 2)).alias("dt"))
    wide = spark.range(5).select("id", F.repeat(F.lit("y"), 100_000).alias("s"), F.lit(D(2026, 1, 1)).alias("dt"))
    small = spark.range(1).select("id", F.lit("z").alias("s"), F.lit(D(2026, 1, 3)).alias("dt"))
    spine = day_spine(spark, "2026-01-01", "2026-01-04") if with_spine else None
    found = write_split(narrow.union(wide).union(small), f"{folder}/t", 64 * 1024, spine=spine)
    wanted = [(D(2026, 1, 1), 5, "replaced"), (D(2026, 1, 2), 20_000, "replaced"), (D(2026, 1, 3), 1, "replaced")]
    assert report(found) == wanted + ([(D(2026, 1, 4), 0, "empty")] if with_spine else [])
    assert len(glob.glob(f"{folder}/t/dt=2026-01-01/*.parquet")) == 5
    assert 4 <= len(glob.glob(f"{folder}/t/dt=2026-01-02/*.parquet")) <= 10
    assert spark.read.parquet(f"{folder}/t").count() == 20_006


def test_write_json(spark, folder):
    df = spark.createDataFrame([(1, None, dt.datetime(2026, 1, 5, 10, tzinfo=dt.timezone.utc), "é \"q\"")],
                               "id long, n string, t timestamp, s string")
    write_json(df, f"{folder}/j")
    lines = [line for f in glob.glob(f"{folder}/j/*.json") for line in open(f, encoding="utf-8")]
    assert lines == ['{"id":1,"n":null,"t":"2026-01-05T10:00:00.000000+00:00","s":"é \\"q\\""}\n']
    with pytest.raises(EmptyExport):
        write_json(df.limit(0), f"{folder}/none")
    assert glob.glob(f"{folder}/none*") == []


def test_write_json_runs_its_input_once_and_keeps_the_old_files(spark, folder):
    ran = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(n):
        ran.add(1)
        return n

    rows = spark.range(100, numPartitions=1).select(counted.asNondeterministic()("id").alias("id"))
    write_json(rows.groupBy("id").count(), f"{folder}/j")
    assert ran.value == 100 and spark.read.json(f"{folder}/j").count() == 100
    with pytest.raises(EmptyExport):
        write_json(rows.where("id < 0"), f"{folder}/j")
    with pytest.raises(Exception, match="no way"):
        write_json(spark.range(5).select(F.raise_error(F.lit("no way")).alias("x")), f"{folder}/j")
    assert spark.read.json(f"{folder}/j").count() == 100
    write_json(spark.range(3), f"{folder}/j")
    assert spark.read.json(f"{folder}/j").count() == 3 and glob.glob(f"{folder}/j_*") == []


def at(text):
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


def test_export_days(spark, folder):
    source = spark.createDataFrame(
        [(1, at("2026-01-01 10:00:00"), "a"), (2, at("2026-01-03 00:00:00"), "b"), (3, at("2026-01-04 00:00:00"), "c")],
        "id int, created_at timestamp, batch_type string")
    found = export_days(source, "batches", f"{folder}/t", "2026-01-01", "2026-01-03")
    assert report(found) == [(D(2026, 1, 1), 1, "replaced"), (D(2026, 1, 2), 0, "empty"), (D(2026, 1, 3), 1, "replaced")]
    assert glob.glob(f"{folder}/t/dt=2026-01-02/*.parquet")
    export_days(source, "batches", f"{folder}/u", "2026-01-01", "2026-01-03", layout="as_is", mark_empty=False)
    assert not glob.glob(f"{folder}/u/dt=2026-01-02") and spark.read.parquet(f"{folder}/u").count() == 2
    stored = spark.read.parquet(f"{folder}/t/dt=2026-01-01")
    assert stored.columns[0] == "batch_type" and len(stored.columns) == 13
    with pytest.raises(ValueError, match="snapshot"):
        export_days(source, "product_catalogue", f"{folder}/t", "2026-01-01", "2026-01-01")


def test_export_snapshots_replace_or_append(spark, folder):
    source = spark.createDataFrame([(1, 5), (2, None)], "id long, price long")
    for _ in range(2):
        export_snapshot(source, "warehouse_products", f"{folder}/r", "2026-01-01")
        export_snapshot(source, "warehouse_products_hourly", f"{folder}/a", "2026-01-01")
    assert spark.read.parquet(f"{folder}/r").count() == 2
    assert spark.read.parquet(f"{folder}/a").count() == 4


def test_export_nested_orders(spark, folder):
    source = spark.createDataFrame(
        [("n", at("2026-01-01 10:00:00"), [("milk", 3.0, 1)])],
        "name string, order_creation_time timestamp, cart array<struct<name: string, price: double, quantity: int>>")
    export_days(source, "cancelled_orders", f"{folder}/t", "2026-01-01", "2026-01-01")
    assert spark.read.parquet(f"{folder}/t").first().cart == [("milk", None, 3, None, 1)]


def test_export_partner_events(spark, folder):
    source = spark.createDataFrame(
        [(i, at("2026-01-01 10:00:00"), '{"user_agent":"partnerapp"}' if i % 2 else "{}") for i in range(100)],
        "event_id long, event_time timestamp, event_properties string")
    for limit in (None, 4096):
        found = export_partner_events(source, f"{folder}/t", "2026-01-01", "2026-01-02", "partnerapp", "mini", limit)
        assert report(found) == [(D(2026, 1, 1), 50, "replaced"), (D(2026, 1, 2), 0, "empty")]
    assert len(glob.glob(f"{folder}/t/dt=2026-01-01/*.parquet")) > 3


def _runner(spark, calls, bad):
    def run(first, last):
        calls.append((first, last))
        spine = day_spine(spark, first, last)
        rows = spine.withColumn("x", F.when(F.col("period").isin(bad), F.raise_error(F.lit("bad day"))).otherwise(F.lit(1)))
        return rows.select("period", F.col("x").cast("long").alias("rows"), F.lit("replaced").alias("status"))
    return run


def test_backfill_is_one_call_when_all_is_well(spark):
    calls = []
    found = backfill(spark, _runner(spark, calls, []), "2026-01-01", "2026-01-10")
    assert len(calls) == 1
    assert found.count() == 10 and found.where("error IS NULL").count() == 10


def test_backfill_names_the_bad_days_and_does_the_others(spark):
    calls, bad = [], [D(2026, 1, 3), D(2026, 1, 9)]
    found = backfill(spark, _runner(spark, calls, bad), "2026-01-01", "2026-01-10", raise_on_failure=False)
    status = {r.period: (r.status, r.rows) for r in found.collect()}
    assert len(status) == 10
    assert [d for d, s in sorted(status.items()) if s[0] == "failed"] == bad
    assert "bad day" in found.where("status = 'failed'").first().error
    with pytest.raises(RangeFailed, match="2026-01-03, 2026-01-09") as caught:
        backfill(spark, _runner(spark, [], bad), "2026-01-01", "2026-01-10")
    assert caught.value.outcome.count() == 10


@pytest.mark.parametrize("mode", ["replace", "append"])
def test_failing_rows_fail_their_period_alone(spark, folder, mode):
    spine = day_spine(spark, "2026-01-01", "2026-01-04")
    old = spark.sql("SELECT explode(sequence(DATE '2026-01-01', DATE '2026-01-04')) AS dt, 0L AS v")
    write_partition(old, f"{folder}/t", spine=spine)
    new = spark.createDataFrame([(D(2026, 1, 1), 1, None), (D(2026, 1, 2), 2, None), (D(2026, 1, 2), 3, "too large"),
                                 (D(2026, 1, 2), 4, "too small"), (D(2026, 1, 3), 5, "too large")], "dt date, v long, why string")
    found = write_partition(new, f"{folder}/t", mode=mode, spine=spine, failing="why")
    done = "replaced" if mode == "replace" else "appended"
    assert [tuple(r) for r in found.orderBy("period").collect()] == [
        (D(2026, 1, 1), 1, done, None), (D(2026, 1, 2), None, "failed", "too large; too small"),
        (D(2026, 1, 3), None, "failed", "too large"), (D(2026, 1, 4), 0, "empty", None)]
    table = spark.read.parquet(f"{folder}/t")
    assert table.columns == ["v", "dt"]
    kept = [(D(2026, 1, 2), 0), (D(2026, 1, 3), 0)]
    assert sorted((r.dt, r.v) for r in table.collect()) == sorted(
        kept + ([(D(2026, 1, 1), 1)] if mode == "replace" else [(D(2026, 1, 1), 0), (D(2026, 1, 1), 1), (D(2026, 1, 4), 0)]))
    assert glob.glob(f"{folder}/t/_staged*") == []


def test_one_bad_day_of_a_year_is_one_call(spark, folder):
    source = spark.sql("SELECT id, timestamp '2026-01-01 10:00:00' + make_dt_interval(CAST(id AS INT)) AS created_at, "
                       "if(id = 100, 'many', CAST(id AS STRING)) AS quantity FROM range(365)")
    calls = []

    def run(first, last):
        calls.append((first, last))
        return export_days(source, "operations", f"{folder}/t", first, last, cast_mode="isolate")

    with pytest.raises(RangeFailed, match="2026-04-11") as caught:
        backfill(spark, run, "2026-01-01", "2026-12-31")
    assert len(calls) == 1 and caught.value.failed == [D(2026, 4, 11)]
    assert caught.value.outcome.where("status = 'failed'").first().error == "values that do not fit: quantity"
    assert spark.read.parquet(f"{folder}/t").count() == 364


def test_split_by_a_few_tasks_makes_the_same_files(spark, folder):
    rows = spark.range(3000, numPartitions=3).selectExpr("id", "repeat('x', CAST(id % 50 AS INT)) AS file",
                                                         "date_add(DATE '2026-01-01', CAST(id % 3 AS INT)) AS dt")
    files = []
    for tasks in (4096, 2, 7):
        path = f"{folder}/t{tasks}"
        for _ in range(2):
            report_ = write_split(rows, path, 2048, spine=day_spine(spark, "2026-01-01", "2026-01-04"), max_tasks=tasks)
        assert report(report_) == [(D(2026, 1, d), 1000 if d < 4 else 0, "replaced" if d < 4 else "empty") for d in (1, 2, 3, 4)]
        table = spark.read.parquet(path)
        assert table.columns == ["id", "file", "dt"] and table.select("id").distinct().count() == table.count() == 3000
        files.append(sorted((r.dt, tuple(sorted(r.ids))) for r in table.groupBy("dt", F.input_file_name().alias("f"))
                            .agg(F.collect_list("id").alias("ids")).collect()))
        assert sorted(os.path.basename(p) for p in glob.glob(f"{path}/*")) == sorted(
            ["_SUCCESS"] * os.path.exists(f"{path}/_SUCCESS") + [f"dt=2026-01-0{d}" for d in (1, 2, 3, 4)])
    assert files[0] == files[1] == files[2] and len(files[0]) > 50


@pytest.mark.parametrize("root", ["{}", "viewfs://split/out"])
def test_many_small_files_are_written_by_few_tasks(spark, folder, root):
    """Each task costs more than a small file; also in a store whose files the driver cannot move itself."""
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.split.link./out", f"file://{folder}")
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(60 * usual).selectExpr("id", "repeat('x', if(id % 100 = 0, 3000, 300)) AS text",
                                              "date_add(DATE '2026-01-01', CAST(id % 2 AS INT)) AS dt")
    path = f"{root.format(folder)}/t"
    write_split(rows, path, 1024)
    names = [os.path.basename(f) for f in glob.glob(f"{folder}/t/dt=*/*.parquet")]
    tasks = {re.fullmatch(r"part-\d{7}-(\d+)-.*", name).group(1) for name in names}
    assert len(names) > 10 * usual >= 10 * len(tasks) and len(set(names)) == len(names)
    assert sorted(os.path.basename(f)[1:-4] for f in glob.glob(f"{folder}/t/dt=*/.*.crc")) == sorted(names)
    assert sorted(d for d in os.listdir(f"{folder}/t") if not d.endswith("_SUCCESS")) == ["dt=2026-01-01", "dt=2026-01-02"]
    table = spark.read.parquet(path)
    assert table.columns == ["id", "text", "dt"] and table.select("id").distinct().count() == table.count() == 60 * usual
    files = table.groupBy(F.input_file_name()).agg(F.count("*").alias("n"), F.sum(row_bytes(rows.schema)).alias("bytes"))
    assert files.where("bytes > 1024 AND n > 1").count() == 0


def test_the_driver_knows_so_many_files_of_a_split_at_a_time(spark, folder, monkeypatch):
    """Written, counted and read: each job has at most FILES_AT_ONCE files, with the sums that all files together have."""
    from bridgecheck.queries import QUERIES
    from daybridge.sinks import partitions

    docs = spark.range(260, numPartitions=3).selectExpr(
        "id AS doc_id", "repeat('x', CASE WHEN id % 130 = 0 THEN 40000 WHEN id % 2 = 0 THEN 20000 ELSE 3000 END) AS text")
    docs.union(spark.sql("SELECT CAST(NULL AS BIGINT), CAST(NULL AS STRING)")).write.parquet(f"{folder}/documents.parquet")
    known, lift, read = [], partitions._lift_files, DataFrameReader.parquet

    def lifted(spark, numbered, *a):
        known.append(len(glob.glob(f"{numbered}/dt=*/*")))
        return lift(spark, numbered, *a)

    def scanned(self, *paths, **options):
        found = read(self, *paths, **options)
        known.append(len([f for f in found.inputFiles() if "/dt=" in f]))
        return found

    monkeypatch.setattr(partitions, "FILES_AT_ONCE", 32, raising=False)
    monkeypatch.setattr(partitions, "_lift_files", lifted)
    monkeypatch.setattr(DataFrameReader, "parquet", scanned)
    found = QUERIES["split_file_sizes"](spark, folder)
    assert found.dtypes == [("dt", "string")] + [(c, "bigint") for c in ("documents", "total_bytes", "files_above", "crowded_above")]
    expected = docs.selectExpr("date_add(DATE '2026-01-01', CAST(doc_id % 3 AS INT)) AS dt", "13 + length(text) AS bytes")
    expected = {r.dt.isoformat(): (r.n, r.bytes, r.above) for r in expected.groupBy("dt").agg(
        F.count("*").alias("n"), F.sum("bytes").alias("bytes"), F.count_if(F.col("bytes") > 32768).alias("above")).collect()}
    n, size, above = expected["2026-01-01"]
    expected["2026-01-01"] = (n + 1, size + 13, above)
    assert {r.dt: (r.documents, r.total_bytes, r.files_above) for r in found.collect()} == expected
    assert found.where("crowded_above > 0").count() == 0
    assert 16 < max(known) <= 32 and sum(known) > 2 * 130


@pytest.mark.parametrize("mode", ["replace", "append"])
@pytest.mark.parametrize("root", ["{}", "viewfs://waves/out"])
def test_split_in_several_jobs_makes_the_same_files(spark, folder, root, mode):
    from daybridge.sinks.partitions import file_batches

    root = root.replace("waves", f"waves{mode}")
    spark._jsc.hadoopConfiguration().set(f"fs.viewfs.mounttable.waves{mode}.link./out", f"file://{folder}")
    rows = spark.range(300, numPartitions=3).selectExpr(
        "id", "repeat('x', if(id % 10 = 0, 900, 100)) AS wave", "date_add(DATE '2026-01-01', CAST(id % 2 AS INT)) AS dt",
        "if(id = 299, 'too large', NULL) AS why")
    spine = day_spine(spark, "2026-01-01", "2026-01-03")
    files = []
    for at_once in (1000, 20):
        path = f"{root.format(folder)}/t{at_once}"
        write_split(rows.where("id < 2"), path, 1024, spine=spine, failing="why")
        found = write_split(rows, path, 1024, spine=spine, mode=mode, failing="why", files_at_once=at_once)
        assert [tuple(r) for r in found.orderBy("period").collect()] == [
            (D(2026, 1, 1), 150, f"{mode.removesuffix('e')}ed", None), (D(2026, 1, 2), None, "failed", "too large"),
            (D(2026, 1, 3), 0, "empty", None)]
        table = spark.read.parquet(path)
        assert table.columns == ["id", "wave", "dt"] and table.count() == 151 + (mode == "append")
        files.append(sorted((r.dt, tuple(sorted(r.ids))) for r in table.groupBy("dt", F.input_file_name().alias("f"))
                            .agg(F.collect_list("id").alias("ids")).collect()))
        batches = list(file_batches(spark, path, 4))
        assert {len(b) for b in batches[:-1]} == {4}
        assert sorted(f.partition(f"/t{at_once}/")[2] for b in batches for f in b) == sorted(
            os.path.relpath(f, f"{folder}/t{at_once}") for f in glob.glob(f"{folder}/t{at_once}/dt=*/*.parquet"))
        assert glob.glob(f"{folder}/t{at_once}/_staged*") == []
    assert files[0] == files[1] and len(files[0]) > 20


def test_a_count_that_differs_in_a_later_job_leaves_the_old_days(spark, folder, monkeypatch):
    from daybridge.sinks import partitions

    rows = spark.range(100, numPartitions=3).selectExpr("id", "repeat('x', 700) AS text", "DATE '2026-01-01' AS dt")
    write_split(rows.where("id < 5"), f"{folder}/t", 1024)
    before, calls = sorted(r.id for r in spark.read.parquet(f"{folder}/t").collect()), []
    plain = partitions.rows_per_period

    def one_less(*a):
        calls.append(a)
        return {d: n - (len(calls) == 3) for d, n in plain(*a).items()}

    monkeypatch.setattr(partitions, "rows_per_period", one_less)
    with pytest.raises(partitions.WriteMismatch, match="the table is as it was"):
        write_split(rows, f"{folder}/t", 1024, files_at_once=30)
    assert len(calls) == 3 and sorted(r.id for r in spark.read.parquet(f"{folder}/t").collect()) == before == [0, 1, 2, 3, 4]
    assert glob.glob(f"{folder}/t/_staged*") == []


def test_settings_for_many_files_last_as_long_as_their_block(spark):
    keys = ["spark.sql.files.maxPartitionNum", "spark.sql.hive.filesourcePartitionFileCacheSize",
            "spark.sql.sources.parallelPartitionDiscovery.parallelism"]
    before = [spark.conf.get(key, None) for key in keys]
    with pytest.raises(KeyError), many_files(spark):
        assert [spark.conf.get(key) for key in keys] == [spark.conf.get("spark.sql.shuffle.partitions"), "0",
                                                         spark.conf.get("spark.sql.shuffle.partitions")]
        raise KeyError
    assert [spark.conf.get(key, None) for key in keys] == before


def test_split_files_of_failing_days_are_not_published(spark, folder):
    source = spark.createDataFrame([(i, at(f"2026-01-0{1 + i % 2} 10:00:00"), '{"user_agent":"partnerapp"}', "x" if i == 41 else "1")
                                    for i in range(100)],
                                   "event_id long, event_time timestamp, event_properties string, adid string")
    found = export_partner_events(source, f"{folder}/t", "2026-01-01", "2026-01-02", "partnerapp", "mini", 4096, "isolate")
    assert [(r.period, r.rows, r.status) for r in found.orderBy("period").collect()] == [
        (D(2026, 1, 1), 50, "replaced"), (D(2026, 1, 2), None, "failed")]
    assert spark.read.parquet(f"{folder}/t").count() == 50


def test_backfill_of_reversed_bounds(spark):
    calls = []
    assert backfill(spark, _runner(spark, calls, []), "2026-01-02", "2026-01-01").count() == 0
    assert calls == []


def test_backfill_without_bounds_takes_the_last_three_days(spark):
    calls = []
    backfill(spark, _runner(spark, calls, []), end="2026-01-10")
    backfill(spark, _runner(spark, calls, []))
    today = dt.datetime.now(dt.timezone.utc).date()
    assert calls[0] == (D(2026, 1, 8), D(2026, 1, 10))
    assert calls[1][1] - calls[1][0] == dt.timedelta(days=2) and today - calls[1][1] <= dt.timedelta(days=1)


def test_backfill_of_months_exports_each(spark, folder):
    orders = spark.createDataFrame(
        [("app", at("2026-01-31 10:00:00"), 1, 1, 1, 10.0, 9.0, 1.0, 1.0, 0.0, 1, None)],
        "platform string, created_at timestamp, warehouse_id long, user_id long, order_id long, original_price double, "
        "oi_price double, delivery_fee_price double, service_fee_price double, refund_amount double, status long, "
        "payment_id string")
    found = backfill(spark, lambda a, b: export_financial(orders, "financial_monthly", f"{folder}/t", a, b),
                     "2026-01-15", "2026-02-01", step="month")
    assert [(r.period, r.rows, r.status) for r in found.orderBy("period").collect()] == [
        (D(2026, 1, 1), 1, "replaced"), (D(2026, 2, 1), 0, "empty")]
    assert spark.read.parquet(f"{folder}/t").first().gtv == 12.0


def test_empty_periods_take_no_jobs_of_their_own(spark, folder):
    rows = spark.createDataFrame([(dt.date(2026, 1, 5), 1), (dt.date(2026, 6, 1), 2)], "dt date, v int")
    spine = day_spine(spark, "2026-01-01", "2026-07-01")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("sparse", "")
    try:
        report = write_partition(rows, f"{folder}/t", spine=spine).collect()
        assert len(tracker.getJobIdsForGroup("sparse")) < 12
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(report) == 182 and sum(r.rows for r in report) == 2
    assert spark.read.parquet(f"{folder}/t").count() == 2 and len(os.listdir(f"{folder}/t/dt=2026-03-03")) >= 1


def _days(spark, path):
    return sorted((r.dt, r.v) for r in spark.read.parquet(path).collect())


@pytest.mark.parametrize("mode", ["replace", "append"])
def test_a_count_that_differs_leaves_the_old_days(spark, folder, monkeypatch, mode):
    """Rows are counted before anything of the table changes."""
    from daybridge.sinks import partitions

    spine = day_spine(spark, "2026-01-01", "2026-01-03")
    old = spark.createDataFrame([(dt.date(2026, 1, d), d) for d in (1, 2, 3)], "dt date, v int")
    write_partition(old, f"{folder}/t", spine=spine)
    before = _days(spark, f"{folder}/t")
    plain = partitions.rows_per_period
    monkeypatch.setattr(partitions, "rows_per_period", lambda *a: {d: n - 1 for d, n in plain(*a).items()})
    new = spark.createDataFrame([(dt.date(2026, 1, 2), 9)] * 3, "dt date, v int")
    with pytest.raises(partitions.WriteMismatch, match="the table is as it was"):
        write_partition(new, f"{folder}/t", mode=mode, spine=spine)
    assert _days(spark, f"{folder}/t") == before
    assert [n for n in os.listdir(f"{folder}/t") if n.startswith("_staged")] == []


def test_a_failing_job_leaves_the_old_days(spark, folder):
    old = spark.createDataFrame([(dt.date(2026, 1, d), d) for d in (1, 2)], "dt date, v int")
    write_partition(old, f"{folder}/t")
    bad = old.withColumn("v", F.when(F.col("v") == 2, F.raise_error(F.lit("no"))).otherwise(F.lit(7)).cast("int"))
    with pytest.raises(Exception, match="no"):
        write_partition(bad, f"{folder}/t")
    assert _days(spark, f"{folder}/t") == [(dt.date(2026, 1, 1), 1), (dt.date(2026, 1, 2), 2)]
    assert [n for n in os.listdir(f"{folder}/t") if n.startswith("_staged")] == []


@pytest.mark.parametrize("mode", ["replace", "append"])
def test_an_interrupted_publication_is_finished(spark, folder, monkeypatch, mode):
    from daybridge.sinks import partitions

    spine = day_spine(spark, "2026-01-01", "2026-01-04")
    old = spark.createDataFrame([(dt.date(2026, 1, d), d) for d in (1, 2, 3, 4)], "dt date, v int")
    write_partition(old, f"{folder}/t", spine=spine)
    new = spark.createDataFrame([(dt.date(2026, 1, d), 10 * d) for d in (1, 2, 3)], "dt date, v int")
    each = partitions._each

    def some(act, days):
        each(act, list(days)[:1])
        raise KeyboardInterrupt

    monkeypatch.setattr(partitions, "_each", some)
    with pytest.raises(KeyboardInterrupt):
        write_partition(new, f"{folder}/t", mode=mode, spine=spine)
    monkeypatch.setattr(partitions, "_each", each)
    assert _days(spark, f"{folder}/t") != sorted([(dt.date(2026, 1, d), 10 * d) for d in (1, 2, 3)])
    assert partitions.finish_published(spark, f"{folder}/t") == 1 and partitions.finish_published(spark, f"{folder}/t") == 0
    added = [(dt.date(2026, 1, d), 10 * d) for d in (1, 2, 3)]
    kept = [] if mode == "replace" else [(dt.date(2026, 1, d), d) for d in (1, 2, 3, 4)]
    assert _days(spark, f"{folder}/t") == sorted(added + kept)
    assert partitions.finish_published(spark, f"{folder}/nowhere") == 0


def test_many_empty_days(spark, folder):
    """Ten years without rows but one day: store calls for different days run at the same time."""
    import time

    spine = day_spine(spark, "2016-01-01", "2025-12-31")
    one = spark.createDataFrame([(dt.date(2020, 2, 29), 1)], "dt date, v int")
    started = time.time()
    report = write_partition(one, f"{folder}/t", spine=spine)
    assert time.time() - started < 120
    assert report.groupBy("status").count().collect().__len__() == 2 and report.count() == 3653
    assert len([n for n in os.listdir(f"{folder}/t") if n.startswith("dt=")]) == 3653
    assert _days(spark, f"{folder}/t") == [(dt.date(2020, 2, 29), 1)]
