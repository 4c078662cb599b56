"""Run registered queries next to their SQL counterparts and compare all rows."""

from __future__ import annotations

import math
import sys
import tempfile
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return repr(value)


def difference(found: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when columns and rows agree, else what does not."""
    rows = con.execute(sql)
    names = [d[0] for d in rows.description]
    if sorted(names) != sorted(found.columns):
        return f"columns {sorted(found.columns)} vs {sorted(names)}"
    names.sort()
    order = {d[0]: i for i, d in enumerate(rows.description)}
    want = sorted([tuple(_plain(r[order[n]]) for n in names) for r in rows.fetchall()], key=str)
    have = sorted([tuple(_plain(r[n]) for n in names) for r in found.collect()], key=str)
    if have == want:
        return None
    if len(have) != len(want):
        return f"{len(have)} rows vs {len(want)}: {[r for r in have if r not in want][:2]} / {want[:2]}"
    first = next((h, w) for h, w in zip(have, want) if h != w)
    return f"first differing row of {names}: {first[0]} vs {first[1]}"


def main(sf_dir: str, *only: str) -> int:
    from bridgecheck.oracle import ORACLE
    from bridgecheck.queries import QUERIES

    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="check-"))
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name, query in QUERIES.items():
        if only and name not in only:
            continue
        started = time.time()
        try:
            found = query(spark, sf_dir)
            problem = difference(found, con, ORACLE[name]) if name in ORACLE else "no SQL"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - started:6.2f}s {'ok' if problem is None else problem}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
