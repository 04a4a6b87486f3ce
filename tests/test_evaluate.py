"""Label matching and reports on hand-made predictions."""

import pytest
from pyspark.sql import functions as F

from labelloom.operators import evaluate as E


def predictions(spark, pairs):
    rows = [(i, f"text {i}", t, p) for i, (t, p) in enumerate(pairs)]
    return spark.createDataFrame(rows, "row_id bigint, input_text string, true_label string, predicted_label string")


def vocabulary(spark, *labels):
    return spark.createDataFrame(list(enumerate(labels)), "idx bigint, category string")


def report(spark, pairs, *labels):
    vocab = vocabulary(spark, *labels)
    counts = E.pair_counts(E.normalize_predictions(predictions(spark, pairs), vocab)).df
    return {r["category"]: tuple(round(v, 4) if isinstance(v, float) else v for v in tuple(r)[2:])
            for r in E.full_report(counts, vocab).collect()}, counts, vocab


def test_exact_match_wins_over_an_earlier_folded_one(spark):
    vocab = vocabulary(spark, "COOK", "cook", " Pilot")
    pairs = [("cook", "cook"), ("x", "Cook "), ("x", "pilot"), ("x", "clerk"), ("x", None)]
    rows = E.normalize_predictions(predictions(spark, pairs), vocab).orderBy("row_id").collect()
    assert [(r["predicted_label"], r["is_valid"]) for r in rows] == [
        ("cook", True), ("COOK", True), (" Pilot", True), ("clerk", False), (None, False),
    ]
    assert tuple(E.prediction_validity(E.normalize_predictions(predictions(spark, pairs), vocab)).first()) == (5, 3, 2)


def test_report_with_all_labels_known(spark):
    pairs = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("b", "a")] + [("a", "zzz")]
    got, counts, vocab = report(spark, pairs, "a", "b", "c")
    assert got == {
        "a": (0.75, 0.75, 0.75, 4), "b": (0.6667, 0.6667, 0.6667, 3), "c": (0.0, 0.0, 0.0, 0),
        "macro avg": (0.4722, 0.4722, 0.4722, 7), "weighted avg": (0.7143, 0.7143, 0.7143, 7),
        "accuracy": (None, None, 0.7143, 7),
    }
    flat = {r["key"]: round(r["value"], 4) for r in E.flatten_report(E.full_report(counts, vocab)).collect()}
    assert flat["a_f1-score"] == 0.75 and flat["macro_avg_support"] == 7 and flat["accuracy"] == 0.7143
    assert len(flat) == 5 * 4 + 1
    assert sum(r["n"] for r in E.confusion_matrix(counts, vocab).collect()) == 7


def test_true_label_outside_the_vocabulary(spark):
    pairs = [("a", "a")] * 2 + [("x", "a")] * 2 + [("b", "b")]
    got, counts, vocab = report(spark, pairs, "a", "b")
    assert got["a"] == (0.5, 1.0, 0.6667, 2)
    assert "accuracy" not in got and got["micro avg"] == (0.6, 1.0, 0.75, 3)
    assert {tuple(r) for r in E.confusion_matrix(counts, vocab).collect()} == {("a", "a", 2), ("b", "b", 1)}
    summary = E.evaluation_summary(E.normalize_predictions(predictions(spark, pairs), vocab)).first()
    assert tuple(summary) == (0.6, 5, 5)


def test_weighted_recall_is_accuracy_when_all_labels_are_known(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    guess = F.when(F.col("doc_id") % 3 == 0, "en").otherwise(F.col("lang"))
    frame = docs.select(F.col("doc_id").alias("row_id"), F.col("text").alias("input_text"), F.col("lang").alias("true_label"), guess.alias("predicted_label"))
    vocab = vocabulary(spark, "de", "en", "es", "fr")
    counts = E.pair_counts(E.normalize_predictions(frame, vocab)).df
    rows = {r["category"]: r for r in E.report_averages(counts, vocab).collect()}
    assert rows["weighted avg"]["recall"] == pytest.approx(rows["accuracy"]["f1_score"])


def test_nothing_valid(spark):
    pairs = [("a", "x"), ("b", "y")]
    got, counts, vocab = report(spark, pairs, "a", "b")
    assert got == {}
    normalized = E.normalize_predictions(predictions(spark, pairs), vocab)
    assert E.accuracy(normalized).first()["accuracy"] == 0.0
    assert tuple(E.evaluation_summary(normalized).first()) == (0.0, 2, 0)
    assert all(r["n"] == 0 for r in E.confusion_dense(counts, vocab).collect())
    wide = {r["true_label"]: (r["a"], r["b"]) for r in E.confusion_wide(counts, vocab).collect()}
    assert wide == {"a": (0, 0), "b": (0, 0)}


def test_no_true_label_in_the_vocabulary_gives_zeros(spark):
    _, counts, vocab = report(spark, [("x", "a"), ("y", "b")], "a", "b")
    assert {r["n"] for r in E.confusion_dense(counts, vocab).collect()} == {0}


def test_examples_include_invalid_ones(spark):
    pairs = [("a", "A "), ("a", "nope")] * 15
    vocab = vocabulary(spark, "a")
    shown = E.example_predictions(E.normalize_predictions(predictions(spark, pairs), vocab)).collect()
    assert len(shown) == 20 and {r["predicted_label"] for r in shown} == {"a", "nope"}


def test_two_thousand_labels(spark):
    labels = [f"label {i:04d}" for i in range(2000)]
    df = spark.range(20000).select(
        F.col("id").alias("row_id"), F.lit("t").alias("input_text"),
        F.format_string("label %04d", F.col("id") % 2000).alias("true_label"),
        F.format_string(" LABEL %04d", (F.col("id") + (F.col("id") % 5 == 0).cast("int")) % 2000).alias("predicted_label"),
    )
    out = E.evaluate(df, vocabulary(spark, *labels))
    assert tuple(out.summary.first()) == (0.8, 20000, 20000)
    assert out.metrics.count() == 2 + 2002 * 4
    assert out.confusion.count() == 2000
