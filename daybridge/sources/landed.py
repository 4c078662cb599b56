"""Files landed by partners: discovery, gzip JSON lines, gzip-wrapped Parquet."""

from __future__ import annotations

import datetime as dt
import gzip
import logging
import shutil
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybridge.functions.jsontext import clean_nulls, is_json, not_json
from daybridge.functions.stores import store_of
from daybridge.functions.times import as_date
from daybridge.session import shared_folder

logger = logging.getLogger(__name__)

# Suffixes of landed files.
LOG_FILES = "*.log.gz"
PARQUET_FILES = "*.parquet.gz"
LANDED_FILES = "*.{log,parquet}.gz"

UNREADABLE = ("fail", "reject")

# What a task reads of a file at a time, and about the bytes of values in a row group it writes.
BLOCK, GROUP_BYTES = 1 << 20, 64 << 20

FILE = "source_file string, source_bytes long, error string"
_FILE = pa.schema([("source_file", pa.string()), ("source_bytes", pa.int64()), ("error", pa.string())])

# The characters stripped from both ends of a line, Unicode whitespace.
BLANKS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
          "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def day_folders(root: str, days: Iterable[dt.date | str]) -> str:
    """One glob over the day folders below ``root``; days without a folder simply do not match."""
    names = ",".join(as_date(d).isoformat() for d in days)
    return f"{root.rstrip('/')}/{{{names}}}"


def _load(spark: SparkSession, kind: str, path: str | Sequence[str], pattern: str,
          **options: str) -> DataFrame | None:
    """Matching files below a path; None and a warning where the path does not exist."""
    reader = spark.read.format(kind).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    try:
        return reader.options(**options).load(path if isinstance(path, str) else list(path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        logger.warning("no %s below %s", pattern, path)
        return None


def _files(spark: SparkSession, path: str | Sequence[str], pattern: str) -> DataFrame:
    found = _load(spark, "binaryFile", path, pattern)
    if found is None:
        return spark.createDataFrame([], "path string, modificationTime timestamp, length long, content binary")
    return found


def _file_day(path: Column) -> Column:
    """The ``YYYY-MM-DD`` folder a file lies in, or NULL."""
    return F.regexp_extract(path, r".*[/=](\d{4}-\d{2}-\d{2})/", 1).try_cast("date")


def landed_files(spark: SparkSession, prefix: str | Sequence[str], pattern: str = LANDED_FILES) -> DataFrame:
    """Path, size and time of landed files below a prefix; contents are not read."""
    files = _files(spark, prefix, pattern)
    return files.select("path", "length", "modificationTime", _file_day(F.col("path")).alias("dt"))


def read_log_lines(spark: SparkSession, path: str | Sequence[str], pattern: str = LOG_FILES,
                   unreadable: str = "fail") -> DataFrame:
    """Stripped, non-blank lines of gzip JSON logs: ``(source_file, source_bytes, dt, line, error)``.

    ``dt`` is the day folder of the file. A damaged file fails the query, or with ``unreadable``
    as ``"reject"`` gives its lines up to the damage and a row with ``error`` in place of a line,
    for which ``damaged_files`` reads every file once more.
    """
    if unreadable not in UNREADABLE:
        raise ValueError(f"unreadable must be one of {UNREADABLE}, not {unreadable!r}")
    rejects = unreadable == "reject"
    found = _load(spark, "text", path, pattern, ignoreCorruptFiles=str(rejects).lower())
    if found is None:
        return spark.createDataFrame(
            [], "source_file string, source_bytes long, dt date, line string, error string")
    lines = found.select(F.col("_metadata.file_path").alias("source_file"),
                         F.col("_metadata.file_size").alias("source_bytes"), F.col("value").alias("line"),
                         F.lit(None).cast("string").alias("error"))
    if rejects:
        lines = lines.unionByName(damaged_files(_files(spark, path, pattern)), allowMissingColumns=True)
    lines = lines.withColumn("line", F.btrim("line", F.lit(BLANKS)))
    return lines.where((F.length("line") > 0) | F.col("error").isNotNull()).select(
        "source_file", "source_bytes", _file_day(F.col("source_file")).alias("dt"), "line", "error")


def damaged_files(files: DataFrame) -> DataFrame:
    """Gzip files, given as ``path`` and ``length``, that cannot be read to their end: ``(source_file, source_bytes, error)``.

    A task streams a file block by block, which checks its length and checksum, and keeps none of it.
    """
    def check(batches):
        for batch in batches:
            found = []
            for path, length in zip(*[c.to_pylist() for c in batch.columns]):
                try:
                    store, name = store_of(path)
                    with store.open_input_stream(name, compression=None) as packed, gzip.open(packed) as text:
                        while text.read(BLOCK):
                            pass
                except Exception as problem:  # any damage belongs to this file alone
                    found.append((path, length, f"{type(problem).__name__}: {problem}"))
            yield pa.RecordBatch.from_pylist([dict(zip(_FILE.names, row)) for row in found], _FILE)

    return files.select("path", "length").mapInArrow(check, FILE)


def parse_log_lines(lines: DataFrame) -> DataFrame:
    """Add ``record``, the cleaned JSON of the line; where there is none ``error`` says why."""
    cleaned = clean_nulls(F.col("line"))
    parsed = lines.withColumn("record", F.when(F.is_valid_utf8("line"), cleaned))
    parsed = parsed.withColumn("record", F.when(is_json(F.col("record")), F.col("record")))
    return parsed.withColumn("error", F.when(F.col("record").isNull(),
                                             F.coalesce("error", not_json(F.col("line"), "line"))))


@contextmanager
def _unpacked(path: str, folder: str) -> Iterator[pq.ParquetFile]:
    """A gzip-wrapped Parquet file, unpacked block by block into the folder as long as it is in use."""
    source, name = store_of(path)
    store, root = store_of(folder)
    plain = f"{root}/_{uuid.uuid4().hex}"
    store.create_dir(root, recursive=True)
    try:
        with (source.open_input_stream(name, compression=None) as packed, gzip.open(packed) as raw,
              store.open_output_stream(plain, compression=None) as out):
            shutil.copyfileobj(raw, out, BLOCK)
        with store.open_input_file(plain) as opened, pq.ParquetFile(opened) as parquet:
            yield parquet
    finally:
        if store.get_file_info(plain).type != fs.FileType.NotFound:
            store.delete_file(plain)


def _rewritten(path: str, length: int, folder: str, target: pa.Schema) -> None:
    """The rows of a wrapped file as plain Parquet of the target's columns: all of them, in one file, or none.

    The file has its name from the path, so a task that runs again replaces it.
    """
    store, root = store_of(folder)
    part = f"{root}/_{uuid.uuid4().hex}"
    with _unpacked(path, folder) as parquet:
        present = [f.name for f in target if f.name in parquet.schema_arrow.names and f.name not in _FILE.names]

        def fitted(batch: pa.RecordBatch) -> pa.RecordBatch:
            known = {"source_file": pa.repeat(path, batch.num_rows), "source_bytes": pa.repeat(length, batch.num_rows)}
            known |= {n: batch.column(n) for n in present}
            return pa.RecordBatch.from_arrays(
                [known[f.name].cast(options=pc.CastOptions(f.type, allow_time_truncate=True))
                 if f.name in known else pa.nulls(batch.num_rows, f.type) for f in target], schema=target)

        try:
            with (store.open_output_stream(part, compression=None) as out,
                  pq.ParquetWriter(out, target) as writer):
                held, size = [], 0
                for batch in parquet.iter_batches(batch_size=10_000, columns=present):
                    held.append(fitted(batch))
                    size += held[-1].nbytes
                    if size > GROUP_BYTES:
                        writer.write_table(pa.Table.from_batches(held))
                        held, size = [], 0
                writer.write_table(pa.Table.from_batches(held, target))
            store.move(part, f"{root}/{uuid.uuid5(uuid.NAMESPACE_URL, path)}.parquet")
        except BaseException:
            if store.get_file_info(part).type != fs.FileType.NotFound:
                store.delete_file(part)
            raise


def unwrap_parquet(files: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of gzip-wrapped Parquet files given as ``path`` and ``length``.

    Columns are taken by name, missing ones are NULL, types are cast. A file that cannot be read
    to its end, or has a value its declared type cannot hold, gives one row with only
    ``source_file``, ``source_bytes`` and ``error`` set and none of its rows, and the others load.

    Files are unpacked once, when this is called: a task streams one into the shared folder and from there, row
    group by row group, into plain Parquet of the declared types, so no file is held in memory, whatever its size.
    What is returned is a scan of those: pruned, filtered and cut like any other, also for a file of which
    the wrapping allows but one task.
    """
    spark = files.sparkSession
    out = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
    out = out.add("source_file", "string").add("source_bytes", "long").add("error", "string")
    target = spark.createDataFrame([], out).toArrow().schema
    folder = shared_folder(spark)
    rows = f"{folder}/rows"

    def unwrap(batches):
        for batch in batches:
            found = []
            for path, length in zip(*[c.to_pylist() for c in batch.columns]):
                error = None
                try:
                    _rewritten(path, length, rows, target)
                except Exception as problem:  # any damage belongs to this file alone
                    error = f"{type(problem).__name__}: {problem}"
                found.append({"source_file": path, "source_bytes": length, "error": error})
            yield pa.RecordBatch.from_pylist(found, _FILE)

    spark.createDataFrame([], out).write.parquet(rows)
    files.select("path", "length").mapInArrow(unwrap, FILE).write.parquet(f"{folder}/files")
    failed = spark.read.schema(FILE).parquet(f"{folder}/files").where("error IS NOT NULL")
    return spark.read.schema(out).parquet(rows).unionByName(failed, allowMissingColumns=True)


def read_wrapped_parquet(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
                         pattern: str = PARQUET_FILES) -> DataFrame:
    """Rows of gzip-wrapped Parquet files below a path, see ``unwrap_parquet``; adds the folder day."""
    rows = unwrap_parquet(_files(spark, path, pattern), schema)
    return rows.withColumn("dt", _file_day(F.col("source_file")))


def wrapped_schema(spark: SparkSession, path: str | Sequence[str], pattern: str = PARQUET_FILES) -> T.StructType:
    """The columns of all gzip-wrapped Parquet files below a path, types widened where files differ.

    Unpacks every file once more; give a declared schema instead where there is one. Only the distinct
    column lists reach the driver.
    """
    folder = shared_folder(spark)

    def schemas(batches):
        for batch in batches:
            found = set()
            for name in batch.column("path").to_pylist():
                try:
                    with _unpacked(name, folder) as parquet:
                        found.add(parquet.schema_arrow.remove_metadata().serialize().to_pybytes())
                except Exception:  # the read itself reports the file
                    continue
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.binary())], names=["columns"])

    listed = _files(spark, path, pattern).select("path").mapInArrow(schemas, "columns binary")
    kinds = [pa.ipc.read_schema(pa.BufferReader(r["columns"])) for r in listed.distinct().collect()]
    if not kinds:
        return T.StructType([])
    merged = pa.unify_schemas(kinds, promote_options="permissive")
    return spark.createDataFrame(merged.empty_table()).schema
