"""Shared-folder storage for intermediate tables.

Intermediates are written once to the folder the cluster names in
`spark.checkpoint.dir`, which cuts lineage and survives lost executors. A table that is
written no longer needs the shuffle files that it was made from: they go at once.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass(frozen=True)
class Settled:
    """A written table with its measured size."""

    df: DataFrame
    rows: int
    nbytes: int


def shared_folder(spark: SparkSession) -> str:
    """Root for intermediates; a machine-local folder is used in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/") + "/labelloom"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="labelloom-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root + "/labelloom"


def fresh_path(spark: SparkSession, purpose: str) -> str:
    """A path of this application that nothing has used yet."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """A write within it deletes its shuffle files when it ends, not when the driver happens to collect garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def settle(df: DataFrame, purpose: str = "table") -> Settled:
    """Write `df` once, measuring it on the way, and return the written table."""
    path = fresh_path(df.sparkSession, purpose)
    seen = Observation()
    measured = df.observe(
        seen,
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(row_bytes(df)), F.lit(0)).cast("bigint").alias("b"),
    )
    with shuffles_dropped(df.sparkSession):
        measured.write.parquet(path)
    size = seen.get
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    return Settled(stored, int(size["n"]), int(size["b"]))


def measure(df: DataFrame) -> Settled:
    """Size of a table that is already stored, without rewriting it."""
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(row_bytes(df)), F.lit(0)).cast("bigint").alias("b"),
    ).first()
    return Settled(df, int(row["n"]), int(row["b"]))


def clear_settled(spark: SparkSession) -> None:
    """Delete what this application has settled; frames that read it can no longer be used."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def row_bytes(df: DataFrame) -> Column:
    """Estimated in-memory bytes of one row."""
    total = F.lit(0).cast("bigint")
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            width = F.coalesce(F.octet_length(col), F.lit(0)) + 16
        elif isinstance(field.dataType, T.BinaryType):
            width = F.coalesce(F.octet_length(col), F.lit(0)) + 16
        elif isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.StringType):
            width = F.aggregate(col, F.lit(32), lambda s, x: s + F.coalesce(F.octet_length(x), F.lit(0)) + 16)
            width = F.coalesce(width, F.lit(32))
        elif isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.NumericType):
            width = 32 + 8 * F.coalesce(F.size(col), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = F.coalesce(F.octet_length(F.to_json(col)), F.lit(0)) + 32
        else:
            width = F.lit(8)
        total = total + width.cast("bigint")
    return total
