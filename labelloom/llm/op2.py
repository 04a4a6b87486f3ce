"""Query: line dedup over `documents`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from labelloom.llm.common import read_table
from labelloom.llm.lines import line_counts


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_counts(read_table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "text", "n_lines", "n_equal", "n_near")
