"""JSON export."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from daybridge.sinks.partitions import drop_staged, observed, replace_folder


class EmptyExport(RuntimeError):
    """An export that must hold rows holds none."""


def write_json(df: DataFrame, path: str, compression: str = "none") -> None:
    """One JSON object per line, nulls kept, ISO times, text unescaped; no rows is an error.

    The input runs once: its rows are observed while they are written beside the path, and only files
    that hold any take the place of what is there. An export without rows, or that fails, leaves it as it was.
    """
    seen, stage = Observation(), f"{path.rstrip('/')}_staged-{uuid.uuid4().hex}"
    try:
        _write(df.observe(seen, F.count(F.lit(1)).alias("rows")), stage, compression)
        if not observed(seen).get("rows", 0):
            raise EmptyExport(f"no rows for {path}, nothing written")
    except BaseException:
        drop_staged(df.sparkSession, stage)
        raise
    replace_folder(df.sparkSession, stage, path)


def _write(df: DataFrame, path: str, compression: str) -> None:
    (df.write
     .option("ignoreNullFields", "false")
     .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
     .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
     .option("compression", compression)
     .json(path))
