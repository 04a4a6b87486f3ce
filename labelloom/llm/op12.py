"""Query: nearest neighbours by inner product over `embeddings`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.llm.collisions import nearest_products
from labelloom.llm.common import read_table

EVERY = 20


def op12_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_products(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)
