"""Checks on listings of stored files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.functions import fixed_values as V


def list_prefix(files: DataFrame, prefix: str, key: str = "key") -> DataFrame:
    """Files under a prefix and their path below it; folder entries are left out."""
    folder = prefix.rstrip("/") + "/" if prefix.rstrip("/") else ""
    inside = files.filter(F.startswith(key, F.lit(folder)) & ~F.endswith(key, F.lit("/")))
    below = inside.withColumn("relative_path", F.substr(F.col(key), F.lit(len(folder) + 1)))
    return below.filter(F.col("relative_path") != "")


def pick_by_suffix(files: DataFrame, suffix: str = V.MODEL_ARCHIVE_SUFFIX, key: str = "key") -> DataFrame:
    """First key, in listing (lexical) order, that ends in `suffix`; no row when there is none."""
    first = files.filter(F.endswith(key, F.lit(suffix))).agg(F.min(key).alias(key))
    return first.filter(F.col(key).isNotNull())


def required_report(files: DataFrame, required: list[str] | None = None, key: str = "key") -> DataFrame:
    """Per required name: whether any key contains it, and the number of keys. One pass, no join."""
    names = V.REQUIRED_MODEL_FILES if required is None else required
    found = [
        F.coalesce(F.bool_or(F.contains(key, F.lit(name))), F.lit(False)).alias(f"_{i}")
        for i, name in enumerate(names)
    ]
    totals = files.agg(F.count(F.lit(1)).alias("n_objects"), *found)
    rows = F.array(
        *[F.struct(F.lit(n).alias("name"), F.col(f"_{i}").alias("present")) for i, n in enumerate(names)]
    )
    return totals.select(F.inline(rows), "n_objects")


def missing_required(files: DataFrame, required: list[str] | None = None, key: str = "key") -> DataFrame:
    """Required names that no key contains."""
    return required_report(files, required, key).filter(~F.col("present")).select("name", "n_objects")


def parse_uri(uri: Column) -> Column:
    """Struct (bucket, object_key, directory, file_name) of a `scheme://bucket/key` URI."""
    path = F.regexp_replace(uri, r"^[A-Za-z][A-Za-z0-9+.\-]*://", "")
    bucket = F.substring_index(path, "/", 1)
    file_name = F.substring_index(uri, "/", -1)
    return F.struct(
        bucket.alias("bucket"),
        F.substr(path, F.length(bucket) + 2).alias("object_key"),
        F.regexp_replace(F.substr(uri, F.lit(1), F.length(uri) - F.length(file_name)), "/$", "").alias("directory"),
        file_name.alias("file_name"),
    )
