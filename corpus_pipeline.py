"""Corpus pipeline: quality, line dedup, near-duplicates, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes each
stage's rows and reads them again as the next one's documents. All but the last return the
columns of `documents`. A document is a row: its id and its content.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.llm.common import read_table, stored
from labelloom.llm.lines import dedup_lines
from labelloom.llm.mixing import mix_documents
from labelloom.llm.op1 import THRESHOLD, learn
from labelloom.llm.op5 import tokenizer_path
from labelloom.llm.packing import pack_documents
from labelloom.llm.quality_model import filter_quality
from labelloom.llm.simhash import drop_near_duplicates as one_of_each_class


def _with_lengths(docs: DataFrame) -> DataFrame:
    """`n_chars` follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else docs


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return filter_quality(docs, learn(docs, read_table(spark, sf_dir, "labels")), THRESHOLD)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an earlier document has; a document of such lines only goes."""
    return _with_lengths(dedup_lines(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exactly one row of each class: the smallest id, null ids last; rows that share an id are told apart."""
    return one_of_each_class(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the target weights, in shuffled shards."""
    return _with_lengths(mix_documents(docs))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality_classifier", keep_quality),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("source_mixing", mix_sources),
    ("packing", pack_windows),
]

# A fitted model and a tokenizer cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
