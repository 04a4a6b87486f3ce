"""Query: alignment of two tokenizers over `documents`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from labelloom.llm.alignment import align_tokens
from labelloom.llm.common import read_table
from labelloom.llm.op5 import tokenizer_path

BYTE_VOCABULARY, PIECE_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"


def op13_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(read_table(spark, sf_dir, "documents"), tokenizer_path(BYTE_VOCABULARY), tokenizer_path(PIECE_VOCABULARY))
