"""Scoring: training, saved models, batch prediction, extraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelloom.catalog.base import RAW_SQL, Registry, raw_rows, sql_digest, sql_split, sql_strip
from labelloom.catalog.encoding import PROMPTS_SQL, test_prompts
from labelloom.catalog.evaluation import rounded
from labelloom.functions import fixed_values as V
from labelloom.operators import bayes as B
from labelloom.operators import evaluate as E
from labelloom.operators import score as M
from labelloom.operators import split as S
from labelloom.plans.shared import fresh_path, settle

registry = Registry()

SQL_NARROW = V.NARROW_SPACE


def parts(spark, sf_dir):
    rows = S.split_rows(raw_rows(spark, sf_dir), "category_label", "row_id")
    return settle(rows.select("row_id", "job_description_text", "category_label", "split"), "parts").df


def fit(rows):
    return M.train_classifier(rows.filter("split = 'train'"), "job_description_text", "category_label")


FLOOR = 0.8


@registry.add("train_classifier", f"""WITH {RAW_SQL},{sql_split('raw')}
SELECT count(*) AS n_rows, count(*) AS n_in_vocabulary, true AS above_floor FROM parts WHERE split = 'test'""")
def train_classifier(spark, sf_dir):
    """Test rows, those predicted with a known label, and whether accuracy reaches a fixed floor."""
    rows = parts(spark, sf_dir)
    labelled = M.classify(fit(rows), rows.filter("split = 'test'")).select(
        "row_id", F.col("category_label").alias("true_label"), "predicted_label"
    )
    vocabulary = S.train_vocabulary(rows, "category_label")
    summary = E.evaluation_summary(E.normalize_predictions(labelled, vocabulary))
    return summary.select(
        F.col("num_total_predictions").alias("n_rows"),
        F.col("num_valid_predictions").alias("n_in_vocabulary"),
        (F.col("accuracy") >= FLOOR).alias("above_floor"),
    )


@registry.add("model_roundtrip", f"""WITH {RAW_SQL},{sql_split('raw')}
SELECT count(*) AS n_rows, count(*) AS n_same FROM parts WHERE split = 'test'""")
def model_roundtrip(spark, sf_dir):
    """Predictions of the test part that a saved and reloaded model repeats."""
    rows = parts(spark, sf_dir)
    model, path = fit(rows), fresh_path(spark, "model")
    M.save_model(model, path)
    test = rows.filter("split = 'test'")
    before = M.classify(model, test)
    both = M.classify(M.load_model(path), before.withColumnRenamed("predicted_label", "before"))
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("before") == F.col("predicted_label")).alias("n_same")
    )


BAYES_SQL = f"""WITH {RAW_SQL},{sql_split('raw')},
seen AS (SELECT * FROM parts WHERE split = 'train' AND category_label IS NOT NULL),
words AS (SELECT row_id, category_label AS label, unnest(regexp_split_to_array(lower(job_description_text), '{SQL_NARROW}+')) AS feature FROM seen),
tallied AS (SELECT feature, label, count(*) AS tf, count(DISTINCT row_id) AS docs FROM words WHERE feature <> '' GROUP BY ALL),
rare AS (SELECT feature, ln(((SELECT count(*) FROM seen) + 1)::double / (sum(docs) + 1)) AS rarity FROM tallied GROUP BY feature),
mass AS (SELECT label, sum(tf * rarity) AS total FROM tallied JOIN rare USING (feature) GROUP BY label),
labels AS (
  SELECT label, ln(n + 1) - ln((SELECT count(*) FROM seen) + (SELECT count(DISTINCT category_label) FROM seen)) AS prior,
         ln(coalesce(total, 0) + (SELECT count(*) FROM rare)) AS norm
  FROM (SELECT category_label AS label, count(*) AS n FROM seen GROUP BY 1) LEFT JOIN mass USING (label)),
asked AS (
  SELECT row_id, feature, count(*) * any_value(rarity) AS x
  FROM (SELECT row_id, unnest(regexp_split_to_array(lower(job_description_text), '{SQL_NARROW}+')) AS feature FROM parts WHERE split = 'test')
  JOIN rare USING (feature) GROUP BY ALL),
scores AS (
  SELECT t.row_id, l.label, any_value(prior) + coalesce(sum(x * (ln(coalesce(tf * rarity, 0) + 1) - norm)), 0) AS score
  FROM (SELECT row_id FROM parts WHERE split = 'test') t CROSS JOIN labels l
  LEFT JOIN asked a ON a.row_id = t.row_id LEFT JOIN rare r ON r.feature = a.feature
  LEFT JOIN tallied c ON c.feature = a.feature AND c.label = l.label GROUP BY ALL)
SELECT row_id, arg_min(label, (-score, label)) AS predicted_label FROM scores GROUP BY row_id"""


@registry.add("classify_by_table", BAYES_SQL)
def classify_by_table(spark, sf_dir):
    """Labels of the test part by a naive Bayes model that is a table of weights."""
    rows = parts(spark, sf_dir)
    model = B.fit_bayes(rows.filter("split = 'train'"), "job_description_text", "category_label")
    return B.classify_by_table(model, rows.filter("split = 'test'"), "job_description_text", "row_id").select("row_id", "predicted_label")


def echo_predictor():
    """Repeats the prompt and appends a label chosen by the prompt's length."""

    def predict(prompts):
        labels = ["en", " FR ", "nothing"]
        return [p + " " + labels[len(p) % 3] + " \n junk" for p in prompts]

    return predict


OUTPUT_SQL = "prompt || ' ' || (['en', ' FR ', 'nothing'])[1 + length(prompt) % 3] || ' ' || chr(10) || ' junk'"


@registry.add("batch_predict", f"WITH {PROMPTS_SQL} SELECT row_id, true_label, {OUTPUT_SQL} AS raw_output FROM prompts")
def batch_predict(spark, sf_dir):
    scored = M.batch_predict(test_prompts(spark, sf_dir), "prompt", echo_predictor)
    return scored.select("row_id", "true_label", "raw_output")


def numbering_predictor():
    """Tells for every prompt its place in the batch, the batch's size, and the first prompt's length."""

    def predict(prompts):
        return [f"{i} of {len(prompts)}, first {len(prompts[0])}" for i, _ in enumerate(prompts)]

    return predict


@registry.add("predict_in_batches", f"""WITH {PROMPTS_SQL},
placed AS (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY {sql_digest('row_id', 'split')}, row_id) - 1 AS place,
                  count(*) OVER (PARTITION BY batch_id) AS n FROM batched)
SELECT row_id, batch_id, place || ' of ' || n || ', first ' || first_value(length(prompt)) OVER (PARTITION BY batch_id ORDER BY place)
       AS raw_output FROM placed""")
def predict_in_batches(spark, sf_dir):
    """The batches that a predictor gets are those of `assign_batches`, whatever the tasks."""
    return M.predict_in_batches(test_prompts(spark, sf_dir), "row_id", "prompt", numbering_predictor, 4, task_batches=5).select(
        "row_id", "batch_id", "raw_output"
    )


# An output that lost a character of its prompt: the length rule then eats one of the label.
CUT_SQL = f"CASE WHEN row_id % 3 = 0 THEN substring({OUTPUT_SQL}, 2) ELSE {OUTPUT_SQL} END"


def first_line(tail: str) -> str:
    return sql_strip(f"string_split({sql_strip(tail)}, chr(10))[1]")


@registry.add("extract_prediction", f"""WITH {PROMPTS_SQL}, outputs AS (SELECT row_id, prompt, {CUT_SQL} AS out FROM prompts)
SELECT row_id, {first_line('substring(out, length(prompt) + 1)')} AS predicted_label,
       {first_line('CASE WHEN starts_with(out, prompt) THEN substring(out, length(prompt) + 1) ELSE out END')} AS by_prefix
FROM outputs""")
def extract_prediction(spark, sf_dir):
    scored = M.batch_predict(test_prompts(spark, sf_dir), "prompt", echo_predictor)
    out = F.when(F.col("row_id") % 3 == 0, F.substr("raw_output", F.lit(2))).otherwise(F.col("raw_output"))
    return scored.withColumn("raw_output", out).select(
        "row_id",
        M.extract_prediction(F.col("raw_output"), F.col("prompt")).alias("predicted_label"),
        M.extract_prediction(F.col("raw_output"), F.col("prompt"), "prefix").alias("by_prefix"),
    )


@registry.add("evaluate_predictor", f"""WITH {PROMPTS_SQL},
outputs AS (SELECT row_id, prompt, true_label, {OUTPUT_SQL} AS out FROM prompts),
told AS (SELECT *, lower({first_line('substring(out, length(prompt) + 1)')}) AS answer FROM outputs)
SELECT round(coalesce((count(*) FILTER (WHERE answer = true_label))
                      / nullif(count(*) FILTER (WHERE answer <> 'nothing'), 0), 0), 6) AS accuracy,
       count(*) AS num_total_predictions, count(*) FILTER (WHERE answer <> 'nothing') AS num_valid_predictions FROM told""")
def evaluate_predictor(spark, sf_dir):
    """The whole way: prompts, predictor, extracted labels, evaluation."""
    scored = M.batch_predict(test_prompts(spark, sf_dir), "prompt", echo_predictor)
    answers = scored.select(
        "row_id",
        F.col("prompt").alias("input_text"),
        "true_label",
        M.extract_prediction(F.col("raw_output"), F.col("prompt")).alias("predicted_label"),
    )
    labels = raw_rows(spark, sf_dir).select(F.col("category_label").alias("category")).distinct()
    return rounded(E.evaluate(answers, S.index_labels(labels)).summary)
