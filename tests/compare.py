"""Compare a registered query with its SQL in DuckDB."""

from __future__ import annotations

import glob
import math
import os
import time

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f'CREATE VIEW "{name}" AS SELECT * FROM read_parquet(\'{path}\')')
    return con


FAMILY = {
    "string": "varchar", "bigint": "bigint", "int": "integer", "double": "double",
    "boolean": "boolean", "float": "float",
}


def _plain(value):
    if value is None:
        return "~null"
    if isinstance(value, bool):
        return f"b{value}"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def compare(spark, con, entry, sf_dir: str) -> tuple[str, float]:
    """("ok" or what differs, Spark seconds)."""
    start = time.time()
    df = entry.run(spark, sf_dir)
    names = sorted(df.columns)
    got = [tuple(r[c] for c in names) for r in df.collect()]
    seconds = time.time() - start
    if entry.sql is None:
        return f"rows-only {len(got)}", seconds
    rel = con.sql(entry.sql)
    if sorted(rel.columns) != names:
        return f"columns {names} vs {sorted(rel.columns)}", seconds
    spark_types = {f.name: FAMILY.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    duck_types = {c: str(t).lower() for c, t in zip(rel.columns, rel.types)}
    if spark_types != duck_types:
        return f"types { {c: (spark_types[c], duck_types[c]) for c in names if spark_types[c] != duck_types[c]} }", seconds
    at = [rel.columns.index(c) for c in names]
    want = [tuple(r[i] for i in at) for r in rel.fetchall()]
    left = sorted(tuple(map(_plain, r)) for r in got)
    right = sorted(tuple(map(_plain, r)) for r in want)
    if len(left) != len(right):
        return f"rows {len(left)} vs {len(right)}", seconds
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        return f"{len(bad)}/{len(left)} rows differ, e.g. {str(bad[0][0])[:300]} vs {str(bad[0][1])[:300]}", seconds
    return f"ok {len(left)}", seconds
