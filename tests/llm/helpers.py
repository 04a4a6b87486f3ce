"""Fixtures with awkward rows, shared by the corpus tests."""

from __future__ import annotations

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, size int, n int, doc string, version int"


def awkward_documents(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing column names."""
    long = " ".join(f"word{i % 997}" for i in range(30_000))
    rows = [
        (1, "one two three four five six seven.\nA second line that is long enough to be compared.", "en", "a"),
        (2, "one two three four five six seven.\nA second line that is long enough to be compared!", "en", "a"),
        (3, None, None, None),
        (None, "no id here but a text of some words", "en", None),
        (4, "", "en", "b"),
        (5, " \t\n\x0b ", "en", "b"),
        (6, long, "en", "c"),
        (7, "repeated row with the mit license", "en", "c"),
        (7, "repeated row with the mit license", "en", "c"),
        (8, "Größe MIT LICENSE; Apache\nLicense! General public license", "de", "c"),
        (9, "!!! ### $$$ |||", None, "d"),
    ]
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), "k", 1, 2, "d", 3) for i, t, lang, s in rows], SCHEMA)


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark, texts, source="s"):
    return spark.createDataFrame([(i, t, source) for i, t in enumerate(texts)], "doc_id bigint, text string, source string")


def same_rows(df):
    return df.agg(F.count(F.lit(1))).first()[0]
