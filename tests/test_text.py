"""Text rules against Python's own string functions."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from labelloom.functions import text as X
from labelloom.functions import fixed_values as V

ODD_SPACE = [chr(c) for c in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, 8192, 8202, 8232, 8233, 8239, 8287, 12288)]


def apply(spark, values, column):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    return [r["o"] for r in df.select("i", column(F.col("t")).alias("o")).orderBy("i").collect()]


def python_clean(text):
    if text is None:
        return "None"
    text = re.sub(r"\[[A-Z]{2,}_(?:UNTRANSLATED|NO_TRANSLATE_CLIENT|FAILED_\w+|ERROR)\]", "", text)
    return " ".join(re.sub(r"\[[A-Z_]+\]", "", text).split())


CASES = [
    None, "", "   ", "plain", "[ES_ERROR] x", "[FR_FAILED_ThrottlingException] y", "[ES_UNTRANSLATED]z",
    "[DE_NO_CLIENT] w", "[ZH-TW_FAILED_X] kept", "[C] genuine", "[c] kept", "a[A_B]b", "[ES_FAILED_né] v",
    *[f"{s}a{s}{s}b {s}c{s}" for s in ODD_SPACE], "a" + "".join(ODD_SPACE) + "b", "a​b﻿",
    "one  two   three", "end\n", "\r\nx\r\n",
]


def test_clean_text(spark):
    assert apply(spark, CASES, X.clean_text) == [python_clean(c) for c in CASES]


def test_strip(spark):
    texts = [c for c in CASES if c is not None]
    assert apply(spark, texts, X.strip) == [t.strip() for t in texts]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.sampled_from("ab[]_AES \n\t" + "".join(ODD_SPACE)), max_size=30), min_size=40, max_size=60))
def test_clean_and_strip_on_random_texts(spark, texts):
    assert apply(spark, texts, X.clean_text) == [python_clean(t) for t in texts]
    assert apply(spark, texts, X.strip) == [t.strip() for t in texts]


def test_clean_is_idempotent_on_ordinary_text(spark, sf_dir):
    once = X.clean_text(F.col("text"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert docs.filter(X.clean_text(once) != once).count() == 0


def test_every_whitespace_character_is_listed():
    assert sorted(V.WHITESPACE) == [chr(c) for c in range(0x10000) if chr(c).isspace()]


def test_coerce_text(spark):
    df = spark.createDataFrame([(1.5, True, None)], "a double, b boolean, c string")
    row = df.select(*[X.coerce_text(F.col(c)).alias(c) for c in df.columns]).first()
    assert tuple(row) == ("1.5", "true", "None")


def test_split_sentences_and_replace_first(spark):
    texts = ["A. B. C", "one", "ends. ", "a.b. c"]
    assert apply(spark, texts, X.split_sentences) == [t.split(". ") for t in texts]
    swap = lambda t: X.replace_first(t, "ab", F.lit("X"))
    texts = ["ab ab", "none", "xabab", "é ab", ""]
    assert apply(spark, texts, swap) == [t.replace("ab", "X", 1) for t in texts]


def test_language_options(spark):
    assert apply(spark, ["en, es ,fr", "en"], X.parse_language_list) == [["en", "es", "fr"], ["en"]]
    pairs = apply(spark, ["English:en, Spanish : es", "broken"], X.parse_language_pairs)
    assert [[tuple(p) for p in row] for row in pairs] == [[("English", "en"), ("Spanish", "es")], [(None, None)]]


@pytest.mark.parametrize("label,key", [(" Data Scientist\n", "data scientist"), ("ΣΑΣ", "σας"), (" X ", "x")])
def test_fold_label_follows_python(spark, label, key):
    assert apply(spark, [label], X.fold_label) == [label.lower().strip()] == [key]
