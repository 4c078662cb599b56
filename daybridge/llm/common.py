"""What the corpus operators share: words, row identity, staging and a bounded pre-filter for joins.

Texts travel to Python as UTF-8 bytes, where splitting and lower-casing A-Z are single C calls.
"""

from __future__ import annotations

import mmap
import os
import sys
import tempfile
import uuid

import numpy as np
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybridge.session import prepare, shared_folder

# Rows and bytes of one Arrow batch: what a Python worker holds of the input at a time.
BATCH_ROWS, BATCH_BYTES = 500, 16 << 20

# Bits of the filter that narrows one side of a join: 2 MB however large the other side is.
FILTER_BITS = 1 << 24

# A group is large when it has more than this part of all grouped rows, so there are fewer large groups than this.
LARGE_GROUPS = 1000

# The bitmap functions of Spark work on pieces of this many bits.
PIECE_BITS = 32768

# ASCII letters and digits and every byte above ASCII stay, A-Z lower-cased; the rest separates.
_WORD_BYTES = bytes(b | 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                    for b in range(256))


def corpus_session(spark: SparkSession) -> SparkSession:
    """The session with bounded Arrow batches, so that long texts do not pile up in a worker."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def spaced_words(text: bytes) -> list[bytes]:
    """Lower-cased words ``[^\\x20\\x09-\\x0D]+``."""
    return text.lower().split()


def plain_words(text: bytes) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``."""
    return text.translate(_WORD_BYTES).split()


def utf8(column: str) -> Column:
    """A text column as its UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("binary"), F.lit(b""))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores put before it until the frame has no such column."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def staged(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """The frame written to the shared folder and read again, so nothing above runs twice."""
    path = f"{shared_folder(df.sparkSession)}/rows"
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _reads_rows_once(df: DataFrame) -> bool:
    """Whether the plan is a scan of files under filters and projections alone, so that each row of a file occurs
    at most once: not behind a join, an explode or a union, nor if a file is named twice."""
    try:
        node = df._jdf.queryExecution().analyzed()
        while node.nodeName() in ("Project", "Filter", "SubqueryAlias", "View"):
            node = node.children().head()
        roots = node.relation().location().rootPaths() if node.nodeName() == "LogicalRelation" else None
        paths = sorted(f"{roots.apply(i).toString()}/" for i in range(roots.size())) if roots else []
    except (AttributeError, Py4JError, PySparkException):  # no such plan: another kind of session or relation
        return False
    return bool(paths) and not any(b.startswith(a) for a, b in zip(paths, paths[1:]))


def located(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """The frame with two columns that identify a row, equal ones included, on every read.

    Rows of files are known by file and position; any other frame is written to the shared folder first, so
    rows that a join, an explode or a union repeats are told apart.
    """
    names = fresh(df, "row_file", "row_index")
    if not _reads_rows_once(df):
        df = staged(df)
    place = df.metadataColumn("_metadata")
    return df.select("*", F.xxhash64(place["file_path"]).alias(names[0]), place["row_index"].alias(names[1])), names


def _bit(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(FILTER_BITS)) + 1


def _flagged(df: DataFrame, keys: list[str], wanted: DataFrame) -> tuple[DataFrame, str]:
    flag, number, piece = fresh(df, "flag", "piece_number", "piece")
    bits = (wanted.select(_bit(keys).alias("bit"))
            .groupBy(F.bitmap_bucket_number("bit").alias(number))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias(piece)))
    position = F.bitmap_bit_position(_bit(keys))
    byte = F.substring(F.col(piece), (position / 8).cast("int") + 1, F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (position % 8).cast("int")) == 1
    found = (df.withColumn(number, F.bitmap_bucket_number(_bit(keys)))
             .join(F.broadcast(bits), number, "left")
             .withColumn(flag, F.coalesce(is_set, F.lit(False))).drop(number, piece))
    return found, flag


def narrowed(df: DataFrame, keys: list[str], wanted: DataFrame) -> DataFrame:
    """The rows whose keys may be in ``wanted``: all that are, and few others.

    A bitmap of fixed size is broadcast, so rows that cannot match never reach a shuffle.
    """
    found, flag = _flagged(df, keys, wanted)
    return found.where(F.col(flag)).drop(flag)


def without(df: DataFrame, keys: list[str], unwanted: DataFrame) -> DataFrame:
    """The rows whose keys are not in ``unwanted``; only rows that the bitmap flags are shuffled."""
    found, flag = _flagged(df, keys, unwanted)
    columns = df.columns
    clear = found.where(~F.col(flag)).select(*[f"`{c}`" for c in columns])
    doubtful = found.where(F.col(flag)).select(*[f"`{c}`" for c in columns])
    return clear.unionByName(doubtful.join(unwanted.select(*keys).distinct(), keys, "left_anti")
                             .select(*[f"`{c}`" for c in columns]))


def joined_by_group(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, how: str) -> DataFrame:
    """``rows`` joined (``left``, ``inner`` or ``left_semi``) with ``groups``, one row per key with its number of rows in ``size``.

    The large groups, fewer than ``LARGE_GROUPS`` whatever the input, are broadcast: their rows stay
    where they are, and no key brings more than that part of the rows into one task of the shuffle.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    is_large = F.col(size) * LARGE_GROUPS > total
    large = groups.where(is_large)
    inside = rows.join(F.broadcast(large), keys, "left_semi" if how == "left_semi" else "inner")
    outside = rows.join(F.broadcast(large.select(*keys)), keys, "left_anti").join(groups.where(~is_large), keys, how)
    return inside.unionByName(outside)


# --- files in the shared folder that workers write and map ------------------------------------------

# Names under which Spark knows stores that pyarrow calls otherwise.
_STORES = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}


def _plain_path(path: str) -> str | None:
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    return path if "://" not in path else None


def store_path(path: str) -> str:
    """A path of a store as pyarrow names it."""
    scheme, rest = path.split("://", 1)
    return f"{_STORES.get(scheme.lower(), scheme.lower())}://{rest}"


def write_shared(path: str, data: bytes) -> None:
    """A whole file or none: a retried task replaces it with the same bytes."""
    local = _plain_path(path)
    if local is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        part = f"{local}.{uuid.uuid4().hex}"
        with open(part, "wb") as out:
            out.write(data)
        os.replace(part, local)
        return
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(store_path(path))
    store.create_dir(os.path.dirname(inner), recursive=True)
    part = f"{inner}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as out:
        out.write(data)
    store.move(part, inner)


def _mapped(file, dtype: str) -> np.ndarray:
    """The array holds the mapping and no file handle: handles are far fewer than mappings."""
    size = os.fstat(file.fileno()).st_size
    if not size:
        return np.empty(0, dtype)
    free = {"trackfd": False} if sys.version_info >= (3, 13) else {}
    return np.frombuffer(mmap.mmap(file.fileno(), size, access=mmap.ACCESS_READ, **free), dtype)


def map_shared(path: str, dtype: str) -> np.ndarray:
    """A file of the shared folder as a memory-mapped array.

    Of a store that cannot be mapped, an unlinked local copy is mapped: nothing is left behind.
    """
    local = _plain_path(path)
    if local is not None:
        with open(local, "rb") as file:
            return _mapped(file, dtype)
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(store_path(path))
    with tempfile.NamedTemporaryFile() as copy, store.open_input_stream(inner) as source:
        while block := source.read(1 << 24):
            copy.write(block)
        copy.flush()
        return _mapped(copy, dtype)
