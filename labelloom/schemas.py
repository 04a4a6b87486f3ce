"""Declared schemas; nothing in the library relies on inference for known shapes."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT_COLUMN = "job_description_text"
LABEL_COLUMN = "category_label"

MESSAGE = T.StructType(
    [T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]
)
MESSAGES = T.StructType([T.StructField("messages", T.ArrayType(MESSAGE))])

RAW_ROWS = T.StructType(
    [
        T.StructField(TEXT_COLUMN, T.StringType()),
        T.StructField(LABEL_COLUMN, T.StringType()),
        T.StructField("source_language", T.StringType()),
        T.StructField("target_language", T.StringType()),
    ]
)

TEMPLATES = T.StructType(
    [
        T.StructField("category", T.StringType()),
        T.StructField("template_idx", T.LongType()),
        T.StructField("template", T.StringType()),
    ]
)

TRAIN_LOG_EVENTS = T.StructType(
    [
        T.StructField("step", T.LongType()),
        T.StructField("epoch", T.DoubleType()),
        T.StructField("logs", T.MapType(T.StringType(), T.DoubleType())),
    ]
)

METRICS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("step", T.LongType()),
    ]
)

PARAMS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)
