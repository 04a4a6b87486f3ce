"""Query: quality scores of `documents`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.llm.common import read_table
from labelloom.llm.quality_model import Model, fit, sample_features, score_documents

THRESHOLD = 0.3


def held_out(key: str) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """The model from labelled rows that are not held out."""
    usable = labels.filter(~held_out("doc_id")).select(F.col("doc_id").alias("key"), "quality")
    return fit(*sample_features(docs, usable))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = score_documents(docs, learn(docs, read_table(spark, sf_dir, "labels")))
    return scored.select(
        F.col("key").alias("doc_id"),
        held_out("key").alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
