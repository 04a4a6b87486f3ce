"""Query: license scan of `documents`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from labelloom.llm.common import read_table
from labelloom.llm.licenses import license_scan


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(read_table(spark, sf_dir, "documents"))
