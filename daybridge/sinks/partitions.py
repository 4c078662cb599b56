"""Date-partitioned Parquet: replace or append, empty periods, verification, file splitting."""

from __future__ import annotations

import datetime as dt
import json
import logging
import os
import uuid
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import batched, chain

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybridge.session import drop_folder, many_files, shared_folder, work_folder

logger = logging.getLogger(__name__)

MODES = ("replace", "append")
LAYOUTS = ("clustered", "as_is")

REPORT = "period date, rows long, status string"
FAILING_REPORT = f"{REPORT}, error string"


class WriteMismatch(RuntimeError):
    """The table does not hold the rows the job wrote."""


def _folder(path: str, column: str, day: dt.date) -> str:
    return f"{path.rstrip('/')}/{column}={day.isoformat()}"


def _periods(spine: DataFrame | None) -> list[dt.date] | None:
    """The periods as a driver list: one date each, as many as the range has days or months."""
    return None if spine is None else sorted(r.period for r in spine.collect())


def rows_per_period(spark: SparkSession, path: str, column: str, schema: T.StructType,
                     days: list[dt.date], files: list[str] | None = None) -> dict[dt.date, int]:
    """Row counts of period folders, or of some ``files`` in them, from file footers: no data column is read."""
    if not days:
        return {}
    full = T.StructType([f for f in schema if f.name != column]).add(column, "date")
    reader = spark.read.schema(full).option("basePath", path).option("pathGlobFilter", "*.parquet")
    if files is not None:
        with many_files(spark):
            return {r[0]: r[1] for r in reader.parquet(*files).groupBy(column).count().collect()}
    glob = ",".join(d.isoformat() for d in days)
    table = reader.parquet(f"{path.rstrip('/')}/{column}={{{glob}}}")
    return {r[0]: r[1] for r in table.groupBy(column).count().collect()}


def _existing(spark: SparkSession, path: str, column: str, schema: T.StructType,
              days: list[dt.date]) -> dict[dt.date, int]:
    try:
        return rows_per_period(spark, path, column, schema, days)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}


def observed(seen: Observation) -> dict:
    """What was observed; nothing where adaptive execution found no rows and left the observing step out."""
    try:
        return seen.get
    except Py4JJavaError as error:
        if "toPyRow" not in str(error):
            raise
        return {}


def holds_rows(spark: SparkSession, path: str) -> bool:
    """Whether anything has been written to the path."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    return hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop.Path(path))


def file_batches(spark: SparkSession, path: str, most: int | None = None) -> Iterator[tuple[str, ...]]:
    """The files in the period folders of a table, ``most`` at a time, to be read in a ``many_files`` block each: a frame
    over all files of a large split takes kilobytes of the driver's memory for each of them."""
    hadoop, store = _store(spark, path)
    is_local = store.getUri().getScheme() == "file"

    def names() -> Iterator[str]:
        for period in store.listStatus(hadoop.Path(path)):
            place = period.getPath()
            if not period.isDirectory() or place.getName().startswith(("_", ".")):
                continue
            if is_local:  # one name after the other, where the store would hold the whole folder
                with os.scandir(place.toUri().getPath()) as entries:
                    yield from (f"{place.toString()}/{entry.name}" for entry in entries)
            else:
                listed = store.listStatusIterator(place)
                while listed.hasNext():
                    yield listed.next().getPath().toString()

    return batched((name for name in names() if not name.rsplit("/", 1)[1].startswith(("_", "."))), most or FILES_AT_ONCE)


# --- publishing: what a job wrote is counted in a staged folder before any folder of the table changes ---

# Store calls for different periods that are under way at a time.
CALLS = 32

# Files of a split that are written, listed or read by one job: the driver has kilobytes for each of them meanwhile.
FILES_AT_ONCE = 8192

# Fixed value: the list of a staged folder's periods, written once its rows are counted.
MANIFEST = "_manifest"


def staged_path(path: str) -> str:
    """A new folder inside the table, in the same store, that readers pass over."""
    return f"{path.rstrip('/')}/_staged-{uuid.uuid4().hex}"


def _store(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    return hadoop, hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def _each[Item](act: Callable[[Item], None], items: Iterable[Item]) -> None:
    """One store action per period or file, many at a time; the first that fails is raised when all have ended."""
    with ThreadPoolExecutor(CALLS) as pool:
        for done in [pool.submit(act, item) for item in items]:
            done.result()


def drop_staged(spark: SparkSession, stage: str) -> None:
    hadoop, store = _store(spark, stage)
    store.delete(hadoop.Path(stage), True)


def replace_folder(spark: SparkSession, stage: str, path: str) -> None:
    """Put a finished folder in the place of another, in the same store."""
    hadoop, store = _store(spark, path)
    store.delete(hadoop.Path(path), True)
    if not store.rename(hadoop.Path(stage), hadoop.Path(path)):
        raise OSError(f"cannot move {stage} to {path}")


def _empty_file(spark: SparkSession, stage: str, column: str, schema: T.StructType, compression: str) -> None:
    """One file without rows below the staged folder, which the store copies to empty periods."""
    body = T.StructType([f for f in schema if f.name != column])
    spark.createDataFrame([], body).coalesce(1).write.option("compression", compression).parquet(f"{stage}/_empty")


def publish(spark: SparkSession, stage: str, path: str, column: str, written: list[dt.date], empty: list[dt.date],
            mode: str = "replace") -> None:
    """Move the counted periods of a staged folder to their places, all calls for a period after each other,
    different periods at the same time.

    The list of periods is written first: ``finish_published`` takes up where an interrupted publication stopped.
    """
    hadoop, store = _store(spark, stage)
    manifest = {"column": column, "mode": mode, "written": [d.isoformat() for d in written], "empty": [d.isoformat() for d in empty]}
    out = store.create(hadoop.Path(stage, MANIFEST), True)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    _promote(spark, stage, path, manifest)


def _promote(spark: SparkSession, stage: str, path: str, manifest: dict) -> None:
    hadoop, store = _store(spark, stage)
    column, replace = manifest["column"], manifest["mode"] == "replace"
    conf = spark._jsc.hadoopConfiguration()
    bodies = [f.getPath() for f in store.listStatus(hadoop.Path(f"{stage}/_empty")) if f.getPath().getName().endswith(".parquet")] \
        if manifest["empty"] else []

    def move(day: dt.date) -> None:
        source, target = hadoop.Path(_folder(stage, column, day)), hadoop.Path(_folder(path, column, day))
        if not store.exists(source):
            return  # moved before an interruption
        if replace:
            store.delete(target, True)
            if not store.rename(source, target):
                raise OSError(f"cannot move {source} to {target}")
            return
        store.mkdirs(target)
        for file in store.listStatus(source):
            if not store.rename(file.getPath(), hadoop.Path(target, file.getPath().getName())):
                raise OSError(f"cannot move {file.getPath()} to {target}")

    def clear(day: dt.date) -> None:
        target = hadoop.Path(_folder(path, column, day))
        store.delete(target, True)
        store.mkdirs(target)
        hadoop.FileUtil.copy(store, bodies[0], store, hadoop.Path(target, bodies[0].getName()), False, conf)

    _each(move, map(dt.date.fromisoformat, manifest["written"]))
    _each(clear, map(dt.date.fromisoformat, manifest["empty"]))
    store.delete(hadoop.Path(stage), True)


def finish_published(spark: SparkSession, path: str) -> int:
    """Finish the publications of a table that were interrupted; folders not yet counted are left alone.

    To be called when no other job publishes to the table. Returns how many were finished.
    """
    hadoop, store = _store(spark, path)
    if not store.exists(hadoop.Path(path)):
        return 0
    stages = [f.getPath().toString() for f in store.listStatus(hadoop.Path(path)) if f.getPath().getName().startswith("_staged-")]
    counted = [s for s in stages if store.exists(hadoop.Path(s, MANIFEST))]
    for stage in counted:
        file = store.open(hadoop.Path(stage, MANIFEST))
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8")
        file.close()
        _promote(spark, stage, path, json.loads(text))
    return len(counted)


def _guarded(column: str, periods: list[dt.date] | None) -> Column:
    """The partition value; a value that is NULL or outside the spine fails the job before commit."""
    day = F.col(column).cast("date")
    if periods is None:
        allowed = day.isNotNull()
    elif (periods[-1] - periods[0]).days + 1 == len(periods):
        allowed = day.between(periods[0], periods[-1])
    else:
        allowed = day.isin(periods)
    message = F.concat(F.lit(f"{column} outside the range to write: "), F.coalesce(day.cast("string"), F.lit("NULL")))
    return F.when(F.coalesce(allowed, F.lit(False)), day).otherwise(F.raise_error(message).cast("date"))


def _lift_files(spark: SparkSession, numbered: str, stage: str, column: str, days: list[dt.date]) -> list[str]:
    """Files of a tree's numbered folders are put right below their staged periods, the number in their names. Returns
    where they are.

    Two listings a period, and one move a file, many at a time. Where the store is a local one the driver moves files
    itself, with their checksums: a call into the JVM takes far longer than the move.
    """
    hadoop, store = _store(spark, stage)
    place, paths = hadoop.Path, hadoop.FileUtil.stat2Paths
    listed = spark._jvm.scala.Predef.genericWrapArray
    is_local = store.getUri().getScheme() == "file"

    def move(pair: tuple[str, str]) -> None:
        if not store.rename(place(pair[0]), place(pair[1])):
            raise OSError(f"cannot move {pair[0]} to {pair[1]}")

    def move_local(pair: tuple[str, str]) -> None:
        (old, name), (new, other) = (os.path.split(path.removeprefix("file:")) for path in pair)
        if os.path.exists(f"{old}/.{name}.crc"):
            os.rename(f"{old}/.{name}.crc", f"{new}/.{other}.crc")
        os.rename(f"{old}/{name}", f"{new}/{other}")

    lifted = []
    for day in days:
        period = store.makeQualified(place(_folder(stage, column, day)))
        store.mkdirs(period)
        target = period.toString()
        files = paths(store.listStatus(paths(store.listStatus(place(_folder(numbered, column, day))))))
        pairs = []
        for file in listed(files).mkString("\n").split("\n"):
            _, folder, name = file.rsplit("/", 2)
            number = int(folder.rsplit("=", 1)[1])
            pairs.append((file, f"{target}/part-{number:07d}-{name.removeprefix('part-')}"))
        if is_local:
            for pair in pairs:
                move_local(pair)
        else:
            _each(move, pairs)
        lifted += [new for _, new in pairs]
    store.delete(place(numbered), True)
    return lifted


def write_partition(df: DataFrame, path: str, column: str = "dt", mode: str = "replace",
                    spine: DataFrame | None = None, layout: str | None = None, compression: str = "gzip",
                    max_records_per_file: int | None = None, mark_empty: bool = True,
                    failing: str | None = None, file_number: str | None = None, more: Iterable[DataFrame] = ()) -> DataFrame:
    """Write rows into period folders and report rows per period.

    ``replace`` swaps exactly the periods written, and with a ``spine`` also every period of it
    that has no rows: such a folder ends up with one empty file, not with its old content. One job
    makes that file for all of them. With ``mark_empty=False`` only folders that hold old rows are
    emptied and the others are not made.
    ``append`` only adds files and needs the spine of the periods it may add to.

    Files are written to a folder of their own and their rows held against those the job observed;
    only then do they move to their periods. A job that fails, or a count that differs, leaves every
    period as it was.

    ``layout="clustered"`` (default) brings a period's rows together first, so files do not
    multiply as tasks x periods; it lets Spark cut a large period into several tasks. ``"as_is"``
    writes without a shuffle, a file for each task.

    ``failing`` names a text column that says why a row fails its period, NULL for sound rows. It is
    observed in the job that writes, and not written: periods with such rows stay as they were and are reported
    as ``failed`` with an ``error``, in a column of its own, and the others are published.

    ``file_number`` names an integer column, not written either: each task sorts its rows by it and starts a
    new file where it changes. ``more`` then has further frames of other numbers, taken, written and counted one after
    the other, so that the driver knows the files of one frame at a time; all are published together.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if layout not in (None, *LAYOUTS):
        raise ValueError(f"layout must be one of {LAYOUTS}, not {layout!r}")
    if mode == "append" and spine is None:
        raise ValueError("append needs the spine of the periods it may add to")
    spark = df.sparkSession
    periods = _periods(spine)
    if periods is not None and not periods:
        return spark.createDataFrame([], REPORT if failing is None else FAILING_REPORT)

    stage = staged_path(path)
    schema = T.StructType([f for f in df.schema if f.name not in (failing, file_number)])

    def write(rows: DataFrame) -> tuple[dict, dict[dt.date, int]]:
        """What was observed of the rows written, and the rows of each period that their files hold."""
        guarded = rows.withColumn(column, _guarded(column, periods))
        if layout != "as_is":
            guarded = guarded.hint("rebalance", column)
        # Observed behind the shuffle: only tasks that commit files are counted.
        seen = Observation()
        sums = [F.count(F.lit(1)).alias("rows"), F.collect_set(column).alias("periods")]
        if failing is not None:  # at most as many as there are periods times reasons
            sums.append(F.collect_set(F.when(F.col(failing).isNotNull(), F.struct(F.col(column).alias("period"), F.col(failing).alias("why"))))
                        .alias("failing"))
        guarded = guarded.observe(seen, *sums)
        if failing is not None:
            guarded = guarded.drop(failing)

        writer = guarded.write.partitionBy(*filter(None, (column, file_number))).option("compression", compression)
        if max_records_per_file:
            writer = writer.option("maxRecordsPerFile", max_records_per_file)
        tree = stage if file_number is None else f"{stage}/_numbered"
        writer.parquet(tree)
        found = observed(seen)
        days = sorted(found.get("periods", []))
        files = None if file_number is None else _lift_files(spark, tree, stage, column, days)
        return found, counted(spark, stage, path, column, schema, days, found.get("rows", 0), files)

    now: Counter[dt.date] = Counter()
    seen_periods: set[dt.date] = set()
    failed: dict[dt.date, set[str]] = {}
    try:
        for rows in chain([df], more):
            found, held = write(rows)
            now.update(held)
            seen_periods.update(found.get("periods", []))
            for row in found.get("failing", []):
                failed.setdefault(row["period"], set()).add(row["why"])
        written = sorted(seen_periods)
        empty = sorted(set(periods or []) - set(written)) if mode == "replace" else []
        if empty and not mark_empty:
            old = _existing(spark, path, column, schema, empty)
            empty = [day for day in empty if old.get(day)]
        if empty:
            _empty_file(spark, stage, column, schema, compression)
    except BaseException:
        drop_staged(spark, stage)
        raise
    publish(spark, stage, path, column, [day for day in written if day not in failed], empty, mode)
    done = "replaced" if mode == "replace" else "appended"
    if failing is None:
        report = [(day, now.get(day, 0), done if day in now else "empty") for day in periods or written]
        return spark.createDataFrame(report, REPORT)
    for day, reasons in sorted(failed.items()):
        logger.error("%s: %s is as it was: %s", path, day, "; ".join(sorted(reasons)))
    return spark.createDataFrame(
        [(day, None, "failed", "; ".join(sorted(failed[day]))) if day in failed
         else (day, now.get(day, 0), done if day in now else "empty", None) for day in periods or written], FAILING_REPORT)


def counted(spark: SparkSession, stage: str, path: str, column: str, schema: T.StructType, written: list[dt.date],
            rows: int, files: list[str] | None = None) -> dict[dt.date, int]:
    """Rows of each period of a staged folder, or of some files in it, from footers; other than the job observed is an error."""
    now = rows_per_period(spark, stage, column, schema, written, *([] if files is None else [files]))
    if sum(now.values()) != rows:
        raise WriteMismatch(f"{path}: wrote {rows} rows, the files hold {sum(now.values())}; the table is as it was")
    return now


def arrow_bytes(value: Column, kind: T.DataType) -> Column:
    """Size of one value in Arrow memory: fixed width, or offset plus payload, plus validity."""
    validity = F.lit(0.125)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return validity + 4 + F.coalesce(F.octet_length(value), F.lit(0))
    if isinstance(kind, T.ArrayType):
        items = F.aggregate(value, F.lit(0.0), lambda total, item: total + arrow_bytes(item, kind.elementType))
        return validity + 4 + F.coalesce(items, F.lit(0.0))
    if isinstance(kind, T.StructType):
        total = validity
        for field in kind:
            total = total + arrow_bytes(value.getField(field.name), field.dataType)
        return total
    widths = {T.BooleanType: 0.125, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4,
              T.DateType: 4, T.DecimalType: 16}
    return validity + F.lit(float(widths.get(type(kind), 8)))


def row_bytes(schema: T.StructType, column: str = "dt") -> Column:
    """Size of a row in Arrow memory without its partition column, rounded up."""
    size = F.lit(0.0)
    for field in schema:
        if field.name != column:
            size = size + arrow_bytes(F.col(f"`{field.name}`"), field.dataType)
    return F.ceil(size).cast("long")


def _numbered_files(rows: DataFrame, column: str, max_bytes: int) -> tuple[DataFrame, int, int]:
    """``rows`` with the number of the ``file`` each goes to, how many files there are, and the bytes of all rows.

    ``rows`` has ``bytes``, ``part`` (its task) and ``place`` (its order). A running total over a
    period, put together from totals of its parts, is cut at equal steps. Only one line per period
    reaches the driver.
    """
    alone = F.col("bytes") * 2 > max_bytes
    packed = F.when(alone, 0).otherwise(F.col("bytes"))
    sums = [F.sum(packed).alias("packed"), F.count_if(alone).alias("alone")]
    periods = rows.groupBy(column).agg(*sums, F.max(packed).alias("widest"), F.sum("bytes").alias("bytes"),
                                       F.count_if(F.col("bytes") > max_bytes).alias("over")).orderBy(column).collect()
    first, steps = 0, []
    for period in periods:
        step = max(1, max_bytes - period["widest"])
        files = -(-period["packed"] // step) if period["packed"] else int(period["alone"] == 0)
        steps.append((period[column], step, first, first + files))
        first += files + period["alone"]
        if period["over"]:
            logger.warning("%s: %d rows above %d bytes have files of their own", period[column], period["over"], max_bytes)
    bounds = rows.sparkSession.createDataFrame(steps, f"{column} date, step long, first long, first_alone long")
    ahead = Window.partitionBy(column).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (rows.groupBy(column, "part").agg(*sums)
             .select(column, "part", *[F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(f"{c}_ahead") for c in ("packed", "alone")])
             .join(F.broadcast(bounds), column))
    within = Window.partitionBy(column, "part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    before = [F.coalesce(F.sum(c).over(within), F.lit(0)).alias(name)
              for c, name in ((packed, "packed_before"), (alone.cast("long"), "alone_before"))]
    own = F.col("first_alone") + F.col("alone_ahead") + F.col("alone_before")
    shared = F.col("first") + F.floor((F.col("packed_ahead") + F.col("packed_before")) / F.col("step"))
    return (rows.select("*", *before).join(parts, [column, "part"])
            .withColumn("file", F.when(alone, own).otherwise(shared).cast("int"))), first, sum(period["bytes"] for period in periods)


# Tasks that a split is written by at most, and bytes of rows that a task of it writes, about.
SPLIT_TASKS, TASK_BYTES = 4096, 64 * 1024 * 1024


def write_split(df: DataFrame, path: str, max_bytes: int, column: str = "dt", spine: DataFrame | None = None,
                mode: str = "replace", failing: str | None = None, max_tasks: int = SPLIT_TASKS,
                files_at_once: int | None = None) -> DataFrame:
    """``write_partition`` with files of at most ``max_bytes`` of Arrow memory each, in one write.

    Every row is measured. Rows of more than half the bound get files of their own, the others are
    packed by a running total, so that files are filled up to the widest of them. Only a single row
    above the bound makes a file above it, which is logged. A file is written by one task. A task costs more than a
    small file, so the number of tasks follows the bytes, with as many as the session has partitions at least and
    ``max_tasks`` at most; more files are written several by each, one after the other: the files are the same.
    Beyond ``files_at_once`` files the rows are staged again by their files, and so many files are written by a job.

    The rows are first written to the shared folder with their sizes: an expensive selection runs
    once, and a retried task finds every row at its place.
    """
    if max_bytes <= 0:
        raise ValueError("max_bytes must be positive")
    spark = df.sparkSession
    taken = {"bytes", "part", "place", "file", "wave", "step", "first", "first_alone", "packed_ahead", "alone_ahead",
             "packed_before", "alone_before"}
    names = {c: f"column {i}" if c.lower() in taken else c for i, c in enumerate(df.columns)}
    with work_folder(spark):
        stage = shared_folder(spark)
        (df.withColumn(column, _guarded(column, _periods(spine))).withColumnsRenamed(names)
         .select("*", row_bytes(T.StructType([T.StructField(names[f.name], f.dataType) for f in df.schema if f.name != failing]), column)
                 .alias("bytes"),
                 F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")).write.parquet(stage))
        rows = spark.read.parquet(stage)
        filed, files, size = _numbered_files(rows, column, max_bytes)
        usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
        columns = [F.col(f"`{names[c]}`").alias(c) for c in df.columns]
        number = f"file-{uuid.uuid4().hex}"

        def tasks_for(some: int, its_bytes: int) -> int:
            return min(some, max_tasks, max(usual, -(-its_bytes // TASK_BYTES)))

        def dealt(some: DataFrame, tasks: int) -> DataFrame:  # in turn: the files of rows on their own, the largest, have neighbouring numbers
            return some.repartitionById(tasks, F.pmod("file", F.lit(tasks))) if tasks else some

        def waves() -> Iterator[DataFrame]:
            again = shared_folder(spark)
            (filed.select(*[F.col(f"`{name}`") for name in names.values()], "bytes", "file", F.expr(f"int(file DIV {at_once})").alias("wave"))
             .write.partitionBy("wave").parquet(again))
            drop_folder(spark, stage)
            with many_files(spark):
                sums = spark.read.parquet(again).groupBy("wave").agg(F.sum("bytes").alias("bytes")).orderBy("wave").collect()
            for wave in sums:
                place = f"{again}/wave={wave['wave']}"
                with many_files(spark):
                    its_rows = spark.read.parquet(place)
                tasks = tasks_for(min(at_once, files - wave["wave"] * at_once), wave["bytes"])
                yield dealt(its_rows, tasks).select(*columns, F.col("file").alias(number))
                drop_folder(spark, place)

        tasks, at_once = tasks_for(files, size), files_at_once or FILES_AT_ONCE
        if files > at_once:
            frames = waves()
            return write_partition(next(frames), path, column, mode, spine, layout="as_is", failing=failing, file_number=number, more=frames)
        if tasks == files:
            return write_partition(dealt(filed, tasks).select(*columns), path, column, mode, spine, layout="as_is", failing=failing)
        return write_partition(dealt(filed, tasks).select(*columns, F.col("file").alias(number)), path, column, mode, spine,
                               layout="as_is", failing=failing, file_number=number)
