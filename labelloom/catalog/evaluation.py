"""Evaluation: label matching, reports, confusion matrices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.catalog.base import Registry, sql_digest, sql_strip, table
from labelloom.operators import evaluate as E
from labelloom.operators.split import index_labels

registry = Registry()


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Synthetic predictions: mostly right, some unknown, padded upper case, or plainly wrong."""
    n = F.col("doc_id")
    answer = (
        F.when(n % 11 == 0, "unknown")
        .when(n % 7 == 0, F.concat(F.lit("  "), F.upper("lang"), F.lit(" ")))
        .when(n % 5 == 0, "en")
        .otherwise(F.col("lang"))
    )
    return table(spark, sf_dir, "documents").select(
        n.alias("row_id"),
        F.col("text").alias("input_text"),
        F.col("lang").alias("true_label"),
        answer.alias("predicted_label"),
    )


def vocabulary(spark: SparkSession, sf_dir: str, *absent: str) -> DataFrame:
    labels = table(spark, sf_dir, "documents").select(F.col("lang").alias("category")).distinct()
    return index_labels(labels.filter(~F.col("category").isin(*absent)) if absent else labels)


def normalized(spark, sf_dir, *absent):
    return E.normalize_predictions(predictions(spark, sf_dir), vocabulary(spark, sf_dir, *absent))


def scored(spark, sf_dir, *absent):
    """(pair counts, vocabulary)."""
    labels = vocabulary(spark, sf_dir, *absent)
    pairs = E.pair_counts(E.normalize_predictions(predictions(spark, sf_dir), labels)).df
    return pairs, labels


def base_sql(absent: str = "") -> str:
    keep = f"WHERE lang <> '{absent}'" if absent else ""
    return f"""
preds AS (
  SELECT doc_id AS row_id, text AS input_text, lang AS true_label,
         CASE WHEN doc_id % 11 = 0 THEN 'unknown' WHEN doc_id % 7 = 0 THEN '  ' || upper(lang) || ' '
              WHEN doc_id % 5 = 0 THEN 'en' ELSE lang END AS predicted_label FROM documents),
vocab AS (
  SELECT row_number() OVER (ORDER BY lang) - 1 AS idx, lang AS category
  FROM (SELECT DISTINCT lang FROM documents {keep})),
folded AS (
  SELECT {sql_strip('lower(category)')} AS folded, arg_min(category, idx) AS category FROM vocab GROUP BY 1),
matched AS (
  SELECT p.*, v.category AS exact_match, f.category AS normalized_match
  FROM preds p LEFT JOIN vocab v ON p.predicted_label = v.category
  LEFT JOIN folded f ON {sql_strip('lower(p.predicted_label)')} = f.folded),
norm AS (
  SELECT row_id, input_text, true_label,
         coalesce(exact_match, normalized_match, predicted_label) AS predicted_label,
         coalesce(exact_match, normalized_match) IS NOT NULL AS is_valid FROM matched),
pairs AS (
  SELECT true_label, predicted_label, count(*) AS n FROM norm WHERE is_valid GROUP BY ALL),
counts AS (
  SELECT idx, category,
         coalesce((SELECT sum(n) FROM pairs WHERE true_label = category AND predicted_label = category), 0)::bigint AS tp,
         coalesce((SELECT sum(n) FROM pairs WHERE predicted_label = category), 0)::bigint AS n_predicted,
         coalesce((SELECT sum(n) FROM pairs WHERE true_label = category), 0)::bigint AS support FROM vocab),
report AS (
  SELECT idx, category, CASE WHEN n_predicted > 0 THEN tp / n_predicted ELSE 0.0::double END AS precision,
         CASE WHEN support > 0 THEN tp / support ELSE 0.0::double END AS recall,
         CASE WHEN n_predicted + support > 0 THEN 2 * tp / (n_predicted + support) ELSE 0.0::double END AS f1_score,
         support FROM counts),
totals AS (
  SELECT (SELECT count(*) FROM pairs WHERE true_label NOT IN (SELECT category FROM vocab)) AS n_unknown,
         (SELECT sum(n) FROM pairs) AS n_valid, sum(tp)::bigint AS tp, sum(n_predicted)::bigint AS n_predicted,
         sum(support)::bigint AS support FROM counts),
averages AS (
  SELECT 'macro avg' AS category, avg(precision) AS precision, avg(recall) AS recall, avg(f1_score) AS f1_score,
         sum(support)::bigint AS support FROM report
  UNION ALL
  SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
         sum(f1_score * support) / sum(support), sum(support)::bigint FROM report
  UNION ALL
  SELECT CASE WHEN n_unknown = 0 THEN 'accuracy' ELSE 'micro avg' END,
         CASE WHEN n_unknown > 0 THEN tp / n_predicted END, CASE WHEN n_unknown > 0 THEN tp / support END,
         CASE WHEN n_unknown > 0 THEN 2 * tp / (n_predicted + support) ELSE tp / n_valid END, support FROM totals)"""


def sql(select: str, absent: str = "") -> str:
    return f"WITH {base_sql(absent)}\n{select}"


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to 6 digits, so that engines agree."""
    return df.select(
        *[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


ROUNDED = "round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score, support"


@registry.add("match_exact", sql("SELECT row_id, predicted_label, exact_match FROM matched", "es"))
def match_exact(spark, sf_dir):
    out = E.match_exact(predictions(spark, sf_dir), vocabulary(spark, sf_dir, "es"))
    return out.select("row_id", "predicted_label", "exact_match")


@registry.add("match_normalized", sql("SELECT row_id, predicted_label, normalized_match FROM matched", "es"))
def match_normalized(spark, sf_dir):
    out = E.match_normalized(predictions(spark, sf_dir), vocabulary(spark, sf_dir, "es"))
    return out.select("row_id", "predicted_label", "normalized_match")


@registry.add("normalize_predictions", sql("SELECT row_id, true_label, predicted_label, is_valid FROM norm", "es"))
def normalize_predictions(spark, sf_dir):
    return normalized(spark, sf_dir, "es").select("row_id", "true_label", "predicted_label", "is_valid")


@registry.add("prediction_validity", sql("""SELECT count(*) AS n_total, count(*) FILTER (WHERE is_valid) AS n_valid,
       count(*) FILTER (WHERE NOT is_valid) AS n_invalid FROM norm""", "es"))
def prediction_validity(spark, sf_dir):
    return E.prediction_validity(normalized(spark, sf_dir, "es"))


@registry.add("accuracy", sql("""SELECT round(coalesce(
       avg(CASE WHEN true_label = predicted_label THEN 1.0::double ELSE 0.0::double END) FILTER (WHERE is_valid), 0.0), 6)
       AS accuracy FROM norm"""))
def accuracy(spark, sf_dir):
    return rounded(E.accuracy(normalized(spark, sf_dir)))


@registry.add("class_report", sql(f"SELECT idx, category, {ROUNDED} FROM report", "es"))
def class_report(spark, sf_dir):
    return rounded(E.class_report(*scored(spark, sf_dir, "es")))


@registry.add("class_report_full_vocabulary", sql(f"SELECT idx, category, {ROUNDED} FROM report"))
def class_report_full_vocabulary(spark, sf_dir):
    return rounded(E.class_report(*scored(spark, sf_dir)))


@registry.add("report_averages", sql(f"SELECT category, {ROUNDED} FROM averages", "es"))
def report_averages(spark, sf_dir):
    return rounded(E.report_averages(*scored(spark, sf_dir, "es")))


@registry.add("report_averages_full_vocabulary", sql(f"SELECT category, {ROUNDED} FROM averages"))
def report_averages_full_vocabulary(spark, sf_dir):
    return rounded(E.report_averages(*scored(spark, sf_dir)))


@registry.add("confusion_matrix", sql(
    "SELECT true_label, predicted_label, n FROM pairs WHERE true_label IN (SELECT category FROM vocab)", "es"))
def confusion_matrix(spark, sf_dir):
    return E.confusion_matrix(*scored(spark, sf_dir, "es"))


@registry.add("confusion_matrix_dense", sql("""
SELECT t.category AS true_label, p.category AS predicted_label, coalesce(n, 0) AS n
FROM vocab t CROSS JOIN vocab p LEFT JOIN pairs ON true_label = t.category AND predicted_label = p.category""", "es"))
def confusion_matrix_dense(spark, sf_dir):
    return E.confusion_dense(*scored(spark, sf_dir, "es"))


@registry.add("confusion_matrix_wide", sql("""
SELECT category AS true_label, coalesce(sum(n) FILTER (WHERE predicted_label = 'de'), 0)::bigint AS de,
       coalesce(sum(n) FILTER (WHERE predicted_label = 'en'), 0)::bigint AS en,
       coalesce(sum(n) FILTER (WHERE predicted_label = 'fr'), 0)::bigint AS fr
FROM vocab LEFT JOIN pairs ON true_label = category GROUP BY category""", "es"))
def confusion_matrix_wide(spark, sf_dir):
    return E.confusion_wide(*scored(spark, sf_dir, "es"))


FLAT_SQL = """
SELECT key, round(value, 6) AS value FROM (
  SELECT replace(category || '_' || metric, ' ', '_') AS key, value FROM (
    SELECT category, unnest(['precision', 'recall', 'f1-score', 'support']) AS metric,
           unnest([precision, recall, f1_score, support::double]) AS value
    FROM (SELECT * EXCLUDE (idx) FROM report UNION ALL SELECT * FROM averages WHERE category <> 'accuracy'))
  UNION ALL SELECT category, f1_score FROM averages WHERE category = 'accuracy')"""


@registry.add("flatten_report", sql(FLAT_SQL))
def flatten_report(spark, sf_dir):
    return rounded(E.flatten_report(E.full_report(*scored(spark, sf_dir))))


@registry.add("flatten_report_uncovered", sql(FLAT_SQL, "es"))
def flatten_report_uncovered(spark, sf_dir):
    return rounded(E.flatten_report(E.full_report(*scored(spark, sf_dir, "es"))))


EXAMPLES_SQL = f"""SELECT row_id, input_text, true_label, predicted_label FROM norm
ORDER BY {sql_digest('row_id', 'split')}, row_id LIMIT 20"""


@registry.add("example_predictions", sql(EXAMPLES_SQL, "es"))
def example_predictions(spark, sf_dir):
    return E.example_predictions(normalized(spark, sf_dir, "es"))


@registry.add("evaluation_summary", sql("""SELECT round(tp / n_valid, 6) AS accuracy,
       (SELECT count(*) FROM norm) AS num_total_predictions, n_valid::bigint AS num_valid_predictions FROM totals"""))
def evaluation_summary(spark, sf_dir):
    return rounded(E.evaluation_summary(normalized(spark, sf_dir)))


@registry.add("evaluation_metrics", sql(f"""
SELECT 'num_invalid_predictions' AS key, (count(*) FILTER (WHERE NOT is_valid))::double AS value FROM norm
UNION ALL SELECT key, value FROM ({FLAT_SQL})"""))
def evaluation_metrics(spark, sf_dir):
    return rounded(E.evaluate(predictions(spark, sf_dir), vocabulary(spark, sf_dir)).metrics)
