"""Session settings every operator relies on, and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Runtime settings that decide results, not speed. Sizing (shuffle partitions, memory, split
# size) belongs to the cluster and is left alone.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.timeType.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the result-relevant settings to an existing session."""
    for key, value in RESULT_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def require(spark: SparkSession, *keys: str) -> None:
    """Fail early when a setting an operator depends on differs from what it needs."""
    for key in keys:
        wanted, found = RESULT_SETTINGS[key], spark.conf.get(key, None)
        if str(found).lower() != wanted.lower():
            raise ValueError(f"{key} is {found!r}, needs {wanted!r}: call daybridge.session.prepare(spark)")


# The folder of the innermost ``work_folder`` block, and for each root the one of this application.
_BLOCK: ContextVar[str | None] = ContextVar("work_folder", default=None)
_OWN: dict[str, str] = {}


def _store(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="daybridge-")
        spark.sparkContext.setCheckpointDir(root)
    root = root.rstrip("/")
    if root not in _OWN:
        own = f"{root}/daybridge-{uuid.uuid4().hex}"
        if isinstance(spark, SparkSession):
            store, place = _store(spark, own)
            store.mkdirs(place)
            store.deleteOnExit(place)
        _OWN[root] = own
    return _OWN[root]


def shared_folder(spark: SparkSession) -> str:
    """A new, unused folder below the one the cluster names in ``spark.checkpoint.dir``.

    What lies there is removed when the ``work_folder`` block ends in which it was asked for, else when the
    driver ends: frames read from it are good that long. Only where the setting is missing and all tasks run in this
    process, as in tests, is a temporary folder made and set; on a cluster, where each machine would have
    its own, that is an error.
    """
    return f"{_BLOCK.get() or _root(spark)}/{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Remove a shared folder that nothing reads any more."""
    store, place = _store(spark, folder)
    store.delete(place, True)


@contextmanager
def work_folder(spark: SparkSession) -> Iterator[None]:
    """A block whose shared folders are removed at its end, for work whose results are by then written elsewhere."""
    folder = shared_folder(spark)
    outer = _BLOCK.set(folder)
    try:
        yield
    finally:
        _BLOCK.reset(outer)
        drop_folder(spark, folder)


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """A block whose file listings take as many tasks as the session has partitions at most, each for many folders.

    Otherwise Spark makes a task for each folder, up to 10,000 of them for every folder of folders.
    """
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, usual = spark.conf.get(key), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(key, str(min(int(before), int(usual))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def many_files(spark: SparkSession) -> Iterator[None]:
    """A block that reads many small files, named one by one or not: few tasks list and read them, and the driver keeps
    no listing beyond the frame that was made from it."""
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    settings = {"spark.sql.files.maxPartitionNum": usual, "spark.sql.hive.filesourcePartitionFileCacheSize": "0"}
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        with few_listing_tasks(spark):
            yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
