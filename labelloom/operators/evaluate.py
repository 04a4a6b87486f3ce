"""Scoring predictions against a label vocabulary.

A vocabulary frame has (idx, category), idx giving the order of the labels.
All metrics come from one table of (true, predicted) counts, which is aggregated
map-side and has at most one row per pair of labels seen.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.functions import fixed_values as V
from labelloom.functions.text import fold_label
from labelloom.operators.split import split_order
from labelloom.plans.joins import lookup_join
from labelloom.plans.shared import Settled, settle

MAX_PIVOT_LABELS = 10_000
MATRIX_BLOCK = 256
MATRIX_TASKS = 4096
METRICS = ["precision", "recall", "f1_score", "support"]


def match_exact(predictions: DataFrame, vocabulary: DataFrame, key: str = "row_id") -> DataFrame:
    """Append `exact_match`: the vocabulary entry equal to the prediction, or null."""
    entries = vocabulary.select(
        F.col("category").alias("predicted_label"), F.col("category").alias("exact_match")
    )
    return lookup_join(predictions, entries, ["predicted_label"], [key])


def match_normalized(predictions: DataFrame, vocabulary: DataFrame, key: str = "row_id") -> DataFrame:
    """Append `normalized_match`: the first entry equal after lower-casing and stripping, or null."""
    entries = (
        vocabulary.groupBy(fold_label(F.col("category")).alias("_folded"))
        .agg(F.min_by("category", "idx").alias("normalized_match"))
    )
    folded = predictions.withColumn("_folded", fold_label(F.col("predicted_label")))
    return lookup_join(folded, settle(entries, "folded-labels"), ["_folded"], [key]).drop("_folded")


def normalize_predictions(predictions: DataFrame, vocabulary: DataFrame, key: str = "row_id") -> DataFrame:
    """Replace predictions by their vocabulary entry; `is_valid` tells whether there is one."""
    matched = match_normalized(match_exact(predictions, vocabulary, key), vocabulary, key)
    entry = F.coalesce("exact_match", "normalized_match")
    return matched.select(
        *[
            F.coalesce(entry, F.col(c)).alias(c) if c == "predicted_label" else F.col(f"`{c}`")
            for c in predictions.columns
        ],
        entry.isNotNull().alias("is_valid"),
    )


def prediction_validity(normalized: DataFrame) -> DataFrame:
    return normalized.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if("is_valid").alias("n_valid"),
        F.count_if(~F.col("is_valid")).alias("n_invalid"),
    )


def accuracy(normalized: DataFrame) -> DataFrame:
    """Share of valid predictions that are right; 0.0 when none is valid."""
    valid = F.count_if("is_valid")
    right = F.count_if(F.col("is_valid") & (F.col("true_label") == F.col("predicted_label")))
    return normalized.agg(F.when(valid > 0, right / valid).otherwise(F.lit(0.0)).alias("accuracy"))


def pair_counts(normalized: DataFrame) -> Settled:
    """(true_label, predicted_label, n) over valid predictions, written once."""
    counts = (
        normalized.filter("is_valid")
        .groupBy("true_label", "predicted_label")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return settle(counts, "label-pairs")


def class_counts(pairs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Per vocabulary label: true positives, predicted rows, support."""
    hit = F.when(F.col("true_label") == F.col("predicted_label"), F.col("n")).otherwise(0)
    by_true = pairs.groupBy(F.col("true_label").alias("category")).agg(
        F.sum("n").alias("_support"), F.sum(hit).alias("_tp")
    )
    by_predicted = pairs.groupBy(F.col("predicted_label").alias("category")).agg(F.sum("n").alias("_predicted"))
    counted = vocabulary.join(by_true, "category", "left").join(by_predicted, "category", "left")
    zero = F.lit(0).cast("bigint")
    return counted.select(
        "idx",
        "category",
        F.coalesce("_tp", zero).alias("tp"),
        F.coalesce("_predicted", zero).alias("n_predicted"),
        F.coalesce("_support", zero).alias("support"),
    )


def _scored_classes(pairs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    counts = class_counts(pairs, vocabulary)
    return counts.select(
        "*",
        _ratio(F.col("tp"), F.col("n_predicted")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("n_predicted") + F.col("support")).alias("f1_score"),
    )


def class_report(pairs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Precision, recall, f1 and support per vocabulary label; a zero division gives 0."""
    return _scored_classes(pairs, vocabulary).select("idx", "category", *METRICS)


def report_averages(pairs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Rows `macro avg`, `weighted avg` and either `accuracy` or `micro avg`.

    `accuracy` is given when the vocabulary covers every label seen; otherwise
    `micro avg` over the vocabulary. No rows when there is no valid prediction.
    """
    rows = _scored_classes(pairs, vocabulary)
    weighted = {m: _ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")) for m in METRICS[:3]}
    totals = rows.agg(
        *[F.avg(m).alias(f"macro_{m}") for m in METRICS[:3]],
        *[w.alias(f"weighted_{m}") for m, w in weighted.items()],
        F.sum("tp").alias("tp"),
        F.sum("n_predicted").alias("n_predicted"),
        F.sum("support").alias("support"),
    )
    nothing = F.lit(None).cast("double")
    micro = (
        _ratio(F.col("tp"), F.col("n_predicted")),
        _ratio(F.col("tp"), F.col("support")),
        _ratio(2 * F.col("tp"), F.col("n_predicted") + F.col("support")),
    )
    # Every valid prediction is a vocabulary label, so `n_predicted` counts all valid rows
    # and `support` falls short of it exactly when a true label is outside the vocabulary.
    covered = F.col("support") == F.col("n_predicted")
    lines = F.array(
        _line(F.lit("macro avg"), *[F.col(f"macro_{m}") for m in METRICS[:3]]),
        _line(F.lit("weighted avg"), *[F.col(f"weighted_{m}") for m in METRICS[:3]]),
        _line(
            F.when(covered, "accuracy").otherwise("micro avg"),
            F.when(covered, nothing).otherwise(micro[0]),
            F.when(covered, nothing).otherwise(micro[1]),
            F.when(covered, micro[0]).otherwise(micro[2]),
        ),
    )
    return totals.filter(F.col("n_predicted") > 0).select(F.inline(lines))


def _line(name: Column, precision: Column, recall: Column, f1: Column) -> Column:
    return F.struct(
        name.alias("category"),
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1_score"),
        F.col("support").alias("support"),
    )


def full_report(pairs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Class rows and average rows in one long table; empty when nothing is valid."""
    classes = class_report(pairs, vocabulary).select(F.lit("class").alias("row_kind"), "category", *METRICS)
    averages = report_averages(pairs, vocabulary).select(F.lit("average").alias("row_kind"), "category", *METRICS)
    both = classes.unionByName(averages)
    return both.limit(0) if pairs.isEmpty() else both


def confusion_matrix(pairs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Long matrix of the pairs that occur; pairs with a label outside the vocabulary are dropped."""
    known = vocabulary.select(F.col("category").alias("true_label"))
    return pairs.join(known, "true_label", "left_semi").select("true_label", "predicted_label", "n")


def confusion_dense(pairs: DataFrame, vocabulary: DataFrame, block: int = MATRIX_BLOCK) -> DataFrame:
    """Long matrix with a cell for every pair of vocabulary labels, zeros included, for any number of labels.

    `vocabulary` has (idx, category), numbered from 0; `pairs` has a pair at most once. Labels lie in blocks of `block`. Every block of rows
    meets every block of columns once; there the codes of the cells that have a count are taken from all codes, and the
    rest are the zeros. So nothing is collected and no cell is joined; the result has labels x labels rows.
    """
    spot = settle(vocabulary.select("category", F.floor(F.col("idx") / block).alias("_block"), (F.col("idx") % block).alias("_in")), "labels")
    entry = F.struct("_in", "category")
    blocks = settle(spot.df.groupBy("_block").agg(F.transform(F.sort_array(F.collect_list(entry)), lambda x: x["category"]).alias("_labels")), "label-blocks")
    rows = spot.df.select(F.col("category").alias("true_label"), F.col("_block").alias("_row"), F.col("_in").alias("_i"))
    columns = spot.df.select(F.col("category").alias("predicted_label"), F.col("_block").alias("_column"), F.col("_in").alias("_j"))
    as_rows, as_columns = Settled(rows, spot.rows, spot.nbytes), Settled(columns, spot.rows, spot.nbytes)
    placed = lookup_join(pairs, as_rows, ["true_label"], ["predicted_label"], how="inner")
    known = settle(lookup_join(placed, as_columns, ["predicted_label"], ["true_label"], how="inner"), "counted-cells").df
    code = (F.col("_i") * block + F.col("_j")).cast("bigint")
    held = known.groupBy("_row", "_column").agg(F.collect_list(code).alias("_held"))
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(blocks.rows - 1).cast("bigint")) if blocks.rows else F.array().cast("array<bigint>")
    grid = blocks.df.select(F.col("_block").alias("_row"), F.col("_labels").alias("_true"), F.explode(every).alias("_column"))
    grid = grid.repartition(max(1, min(blocks.rows**2, MATRIX_TASKS)), "_row", "_column")
    met = grid.join(blocks.df.select(F.col("_block").alias("_column"), F.col("_labels").alias("_predicted")), "_column")
    met = met.join(held, ["_row", "_column"], "left")
    ids = lambda labels: F.sequence(F.lit(0).cast("bigint"), (F.size(labels) - 1).cast("bigint"))
    codes = F.flatten(F.transform(ids("_true"), lambda i: F.transform(ids("_predicted"), lambda j: i * block + j)))
    none = F.array().cast("array<bigint>")
    zeros = met.select("_true", "_predicted", F.explode(F.array_except(codes, F.coalesce("_held", none))).alias("_code")).select(
        F.get("_true", F.floor(F.col("_code") / block).cast("int")).alias("true_label"),
        F.get("_predicted", (F.col("_code") % block).cast("int")).alias("predicted_label"),
        F.lit(0).cast("bigint").alias("n"),
    )
    return known.select("true_label", "predicted_label", "n").unionByName(zeros)


def confusion_wide(pairs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """One row per true label, one column per predicted label, in vocabulary order."""
    labels = label_list(vocabulary)
    counts = pairs.groupBy("true_label").pivot("predicted_label", labels).agg(F.sum("n"))
    rows = vocabulary.select(F.col("category").alias("true_label")).join(counts, "true_label", "left")
    zero = F.lit(0).cast("bigint")
    return rows.select("true_label", *[F.coalesce(F.col(f"`{c}`"), zero).alias(c) for c in labels])


def label_list(vocabulary: DataFrame) -> list[str]:
    """Vocabulary in order, on the driver; only for the layout with a column per label."""
    rows = vocabulary.orderBy("idx").select("category").take(MAX_PIVOT_LABELS + 1)
    if len(rows) > MAX_PIVOT_LABELS:
        raise ValueError(f"more than {MAX_PIVOT_LABELS} labels: use the long confusion matrix")
    return [r["category"] for r in rows]


def flatten_report(report: DataFrame) -> DataFrame:
    """(key, value) rows named `{category}_{metric}` with blanks as underscores."""
    shown = {"precision": "precision", "recall": "recall", "f1_score": "f1-score", "support": "support"}
    metrics = F.array(
        *[F.struct(F.lit(name).alias("metric"), F.col(c).cast("double").alias("value")) for c, name in shown.items()]
    )
    scalar = F.array(F.struct(F.lit("").alias("metric"), F.col("f1_score").alias("value")))
    single = (F.col("row_kind") == "average") & (F.col("category") == "accuracy")
    long = report.select("category", single.alias("_single"), F.inline(F.when(single, scalar).otherwise(metrics)))
    name = F.when(F.col("_single"), F.col("category")).otherwise(F.concat_ws("_", "category", "metric"))
    return long.select(F.translate(name, " ", "_").alias("key"), "value")


def example_predictions(normalized: DataFrame, key: str = "row_id", n: int = V.EXAMPLE_ROWS) -> DataFrame:
    """First `n` predictions in reading order, invalid ones included."""
    return (
        normalized.orderBy(*split_order(key))
        .limit(n)
        .select(key, "input_text", "true_label", "predicted_label")
    )


def evaluation_summary(normalized: DataFrame) -> DataFrame:
    """One row: accuracy and prediction totals."""
    valid = F.count_if("is_valid")
    right = F.count_if(F.col("is_valid") & (F.col("true_label") == F.col("predicted_label")))
    return normalized.agg(
        F.when(valid > 0, right / valid).otherwise(F.lit(0.0)).alias("accuracy"),
        F.count(F.lit(1)).alias("num_total_predictions"),
        valid.alias("num_valid_predictions"),
    )


@dataclass(frozen=True)
class Evaluation:
    summary: DataFrame
    report: DataFrame
    confusion: DataFrame
    metrics: DataFrame
    examples: DataFrame


def evaluate(predictions: DataFrame, vocabulary: DataFrame, key: str = "row_id") -> Evaluation:
    """All evaluation frames for (key, input_text, true_label, predicted_label) rows.

    Predictions are written once, however many of the frames are read.
    """
    vocabulary = settle(vocabulary, "vocabulary").df
    normalized = settle(normalize_predictions(predictions, vocabulary, key), "normalized").df
    pairs = pair_counts(normalized).df
    report = full_report(pairs, vocabulary)
    summary = evaluation_summary(normalized)
    totals = summary.select(
        F.inline(
            F.array(
                F.struct(F.lit("accuracy").alias("key"), F.col("accuracy").alias("value")),
                F.struct(
                    F.lit("num_invalid_predictions").alias("key"),
                    (F.col("num_total_predictions") - F.col("num_valid_predictions")).cast("double").alias("value"),
                ),
            )
        )
    )
    flat = flatten_report(report).filter(F.col("key") != "accuracy")
    return Evaluation(
        summary, report, confusion_matrix(pairs, vocabulary), totals.unionByName(flat),
        example_predictions(normalized, key),
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0)).cast("double")
