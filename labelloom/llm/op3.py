"""Query: near-duplicate classes of `embeddings`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from labelloom.llm.common import read_table
from labelloom.llm.vectors import near_vectors


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read_table(spark, sf_dir, "embeddings"))
