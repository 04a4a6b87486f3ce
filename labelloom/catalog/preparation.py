"""Preparation: projections, checks, splits, vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.catalog.base import (
    RAW_SQL, Registry, raw_rows, sql_clean, sql_digest, sql_quotas, sql_split, sql_strip, table,
)
from labelloom.functions import text as X
from labelloom.operators import prepare as P
from labelloom.operators import split as S

registry = Registry()

CAP = 100
PREFIX = "Classify the following job description. Job Description: "

MARKERS = ["", "[ES_FAILED_ThrottlingException] ", "[FR_ERROR] ", "[DE_NO_CLIENT] ", "[ZH-TW_FAILED_X] "]
MARKER_SQL = (
    "CASE row_id % 5 WHEN 0 THEN '' WHEN 1 THEN '[ES_FAILED_ThrottlingException] ' "
    "WHEN 2 THEN '[FR_ERROR] ' WHEN 3 THEN '[DE_NO_CLIENT] ' ELSE '[ZH-TW_FAILED_X] ' END"
)


def marked_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    marker = F.get(F.array(*[F.lit(m) for m in MARKERS]), (F.col("row_id") % 5).cast("int"))
    return raw_rows(spark, sf_dir).withColumn(
        "job_description_text", F.concat(marker, F.col("job_description_text"))
    )


MARKED_SQL = f"""{RAW_SQL},
marked AS (
  SELECT row_id, {MARKER_SQL} || job_description_text AS job_description_text, category_label, source FROM raw)"""


@registry.add("check_columns", f"""WITH {RAW_SQL}
SELECT row_id, job_description_text, category_label FROM raw""")
def check_columns(spark, sf_dir):
    rows = P.check_columns(raw_rows(spark, sf_dir), "job_description_text", "category_label")
    return rows.select("row_id", "job_description_text", "category_label")


@registry.add("clean_text", f"""WITH {MARKED_SQL}
SELECT row_id, {sql_clean('job_description_text')} AS cleaned FROM marked""")
def clean_text(spark, sf_dir):
    return marked_rows(spark, sf_dir).select(
        "row_id", X.clean_text(F.col("job_description_text")).alias("cleaned")
    )


@registry.add("coerce_text", """
SELECT doc_id AS row_id,
       coalesce(CASE WHEN doc_id % 13 = 0 THEN NULL ELSE text END, 'None') AS from_text,
       coalesce(CAST(CASE WHEN doc_id % 13 = 0 THEN NULL ELSE n_chars END AS varchar), 'None') AS from_number
FROM documents""")
def coerce_text(spark, sf_dir):
    keep = F.col("doc_id") % 13 != 0
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"),
        X.coerce_text(F.when(keep, F.col("text"))).alias("from_text"),
        X.coerce_text(F.when(keep, F.col("n_chars"))).alias("from_number"),
    )


@registry.add("build_prompt", f"""WITH {MARKED_SQL}
SELECT row_id, '{PREFIX}' || {sql_clean('job_description_text')} AS prompt FROM marked""")
def build_prompt(spark, sf_dir):
    return marked_rows(spark, sf_dir).select(
        "row_id", X.build_prompt(X.clean_text(F.col("job_description_text"))).alias("prompt")
    )


@registry.add("build_messages", f"""WITH {MARKED_SQL}
SELECT row_id, 'user' AS role_0, '{PREFIX}' || {sql_clean('job_description_text')} AS content_0,
       'assistant' AS role_1, category_label AS content_1, 2::bigint AS n_messages FROM marked""")
def build_messages(spark, sf_dir):
    m = F.col("messages")
    return P.to_messages(marked_rows(spark, sf_dir)).select(
        "row_id",
        m[0]["role"].alias("role_0"), m[0]["content"].alias("content_0"),
        m[1]["role"].alias("role_1"), m[1]["content"].alias("content_1"),
        F.size(m).cast("bigint").alias("n_messages"),
    )


@registry.add("project_messages", f"""WITH {RAW_SQL}
SELECT 'user: ' || '{PREFIX}' || {sql_clean('job_description_text')} || ' / assistant: ' || category_label
       AS messages FROM raw""")
def project_messages(spark, sf_dir):
    only = P.project_messages(P.to_messages(raw_rows(spark, sf_dir)))
    shown = F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"]))
    return only.select(F.array_join(shown, " / ").alias("messages"))


@registry.add("filter_valid_conversations", """
SELECT conv_id, min(text) FILTER (WHERE place = 1) AS first_content, min(role) FILTER (WHERE place = 1) AS first_role,
       min(text) FILTER (WHERE place = 2) AS second_content, min(role) FILTER (WHERE place = 2) AS second_role
FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place FROM conversations)
GROUP BY conv_id HAVING count(*) = 2""")
def filter_valid_conversations(spark, sf_dir):
    pairs = P.filter_valid(P.pair_turns(table(spark, sf_dir, "conversations"), "conv_id"))
    m = F.col("messages")
    return pairs.select(
        "conv_id",
        m[0]["content"].alias("first_content"), m[0]["role"].alias("first_role"),
        m[1]["content"].alias("second_content"), m[1]["role"].alias("second_role"),
    )


def message_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations of one to four messages per document, in four shapes."""
    prompt = P.message("user", X.build_prompt(X.clean_text(F.col("text"))))
    answer = P.message("assistant", F.col("lang"))
    system = P.message("system", F.concat(F.lit("Source "), F.col("source")))
    follow = P.message("user", F.col("source"))
    shape = F.col("doc_id") % 4
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"),
        F.when(shape == 0, F.array(prompt, answer))
        .when(shape == 1, F.array(system, prompt, answer))
        .when(shape == 2, F.array(prompt))
        .otherwise(F.array(prompt, answer, follow, answer)).alias("messages"),
    )


MESSAGE_SQL = f"""
base AS (
  SELECT doc_id AS row_id, doc_id % 4 AS shape, lang, 'Source ' || source AS system, source,
         '{PREFIX}' || {sql_clean('text')} AS prompt FROM documents)"""


@registry.add("extract_prompt_label", f"""WITH {MESSAGE_SQL}
SELECT row_id, CASE WHEN shape = 1 THEN system ELSE prompt END AS prompt,
       CASE shape WHEN 1 THEN prompt WHEN 2 THEN NULL ELSE lang END AS true_label FROM base""")
def extract_prompt_label(spark, sf_dir):
    return P.prompt_and_label(message_rows(spark, sf_dir)).select("row_id", "prompt", "true_label")


@registry.add("explode_role_content", f"""WITH {MESSAGE_SQL}
SELECT row_id, lang AS content FROM base WHERE shape <> 2
UNION ALL SELECT row_id, lang AS content FROM base WHERE shape = 3""")
def explode_role_content(spark, sf_dir):
    return P.role_contents(message_rows(spark, sf_dir), "assistant").select("row_id", "content")


# --- splits ---


@registry.add("split_test", f"""WITH {RAW_SQL},{sql_split('raw', 'source', val=0.0)}
SELECT row_id, source, split FROM parts""")
def split_test(spark, sf_dir):
    return S.hold_out(raw_rows(spark, sf_dir), "source", "row_id").select("row_id", "source", "split")


@registry.add("split_three_way", f"""WITH {RAW_SQL},{sql_split('raw')}
SELECT row_id, category_label, split FROM parts""")
def split_three_way(spark, sf_dir):
    return parts(spark, sf_dir).select("row_id", "category_label", "split")


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.split_rows(raw_rows(spark, sf_dir), "category_label", "row_id")


@registry.add("split_unstratified", f"""WITH {RAW_SQL},
whole AS (SELECT *, 'all' AS stratum_name FROM raw),{sql_split('whole', 'stratum_name')}
SELECT row_id, split FROM parts""")
def split_unstratified(spark, sf_dir):
    return S.split_rows(raw_rows(spark, sf_dir), "category_label", "row_id", stratify=False).select(
        "row_id", "split"
    )


@registry.add("split_grouped", f"""WITH {RAW_SQL},
units AS (SELECT DISTINCT category_label, md5(job_description_text) AS row_id FROM raw),
{sql_split('units').lstrip()}
SELECT r.row_id, p.split FROM raw r
JOIN parts p ON p.category_label = r.category_label AND p.row_id = md5(r.job_description_text)""")
def split_grouped(spark, sf_dir):
    rows = raw_rows(spark, sf_dir).withColumn("copy_group", F.md5("job_description_text"))
    return S.split_rows(rows, "category_label", "row_id", group_key="copy_group").select("row_id", "split")


@registry.add("check_strata", f"""WITH {RAW_SQL},{sql_quotas('raw', 'source')},
sizes AS (
  SELECT count(*) AS n_classes, min(n)::bigint AS smallest, sum(n)::bigint AS n_rows, sum(n_test)::bigint AS n_test,
         sum(n - n_test)::bigint AS n_train, count(*) FILTER (WHERE n > n_test) AS n_classes_left,
         (min(n - n_test) FILTER (WHERE n > n_test))::bigint AS smallest_left, sum(n_validation)::bigint AS n_validation FROM quotas)
SELECT *, (n_classes <= 1 OR (smallest >= 2 AND least(n_test, n_train) >= n_classes)) AS can_stratify_test,
       (n_classes_left <= 1 OR (smallest_left >= 2 AND least(n_validation, n_train - n_validation) >= n_classes_left))
         AS can_stratify_validation FROM sizes""")
def check_strata(spark, sf_dir):
    return S.strata_report(raw_rows(spark, sf_dir), "source")


CAPPED_SQL = f"""WITH {RAW_SQL},{sql_split('raw')},
capped AS (
  SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY split ORDER BY {sql_digest('row_id', 'split')}, row_id) AS cap_place FROM parts)
  WHERE cap_place <= {CAP})"""


@registry.add("cap_splits", f"""{CAPPED_SQL}
SELECT row_id, category_label, split FROM capped""")
def cap_splits(spark, sf_dir):
    return S.cap_splits(parts(spark, sf_dir), "row_id", CAP).select("row_id", "category_label", "split")


@registry.add("train_vocabulary", f"""{CAPPED_SQL}
SELECT row_number() OVER (ORDER BY source) - 1 AS idx, source AS category
FROM (SELECT DISTINCT source FROM capped WHERE split = 'train')""")
def train_vocabulary(spark, sf_dir):
    return S.train_vocabulary(S.cap_splits(parts(spark, sf_dir), "row_id", CAP), "source")


@registry.add("split_counts", f"""WITH {RAW_SQL},{sql_split('raw')}
SELECT split, count(*) AS n_rows, count(DISTINCT category_label) AS n_categories FROM parts GROUP BY split""")
def split_counts(spark, sf_dir):
    return S.split_counts(parts(spark, sf_dir), "category_label")


@registry.add("prepare_conversations", f"""{CAPPED_SQL}
SELECT row_id, split, '{PREFIX}' || {sql_clean('job_description_text')} AS prompt, category_label AS true_label
FROM capped""")
def prepare_conversations(spark, sf_dir):
    ready = P.prepare(raw_rows(spark, sf_dir), cap=CAP, key="row_id")
    return P.prompt_and_label(ready.conversations).select("row_id", "split", "prompt", "true_label")


@registry.add("prepare_all_rows", f"""WITH {RAW_SQL},{sql_split('raw')}
SELECT row_id, split, '{PREFIX}' || {sql_clean('job_description_text')} AS prompt, category_label AS true_label FROM parts""")
def prepare_all_rows(spark, sf_dir):
    ready = P.prepare(raw_rows(spark, sf_dir), key="row_id")
    return P.prompt_and_label(ready.conversations).select("row_id", "split", "prompt", "true_label")


@registry.add("prepare_metrics", f"""WITH {RAW_SQL},{sql_split('raw')}
SELECT 'num_unique_categories' AS key, count(DISTINCT category_label)::double AS value FROM parts WHERE split = 'train'
UNION ALL SELECT split || '_sample_count', count(*)::double FROM parts GROUP BY split""")
def prepare_metrics(spark, sf_dir):
    return P.preparation_metrics(P.settle_prepared(P.prepare(raw_rows(spark, sf_dir), key="row_id")))


# Rows that have no key: known by a digest of their columns. `documents` holds exact copies, which a cut can run through.
KEYLESS_SQL = f"""{RAW_SQL},
keyless AS (
  SELECT md5(concat_ws(',', coalesce(md5(job_description_text), '-'), coalesce(md5(category_label), '-'))) AS row_id,
         job_description_text, category_label FROM raw),{sql_split('keyless')}"""


def keyless_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_rows(spark, sf_dir).select("job_description_text", "category_label")


@registry.add("prepare_without_key", f"""WITH {KEYLESS_SQL},
placed AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY {sql_digest('row_id', 'split')}, row_id) AS place FROM parts)
SELECT row_id, split, '{PREFIX}' || {sql_clean('job_description_text')} AS prompt, category_label AS true_label
FROM placed WHERE place <= {CAP}""")
def prepare_without_key(spark, sf_dir):
    ready = P.prepare(keyless_rows(spark, sf_dir), cap=CAP)
    return P.prompt_and_label(ready.conversations).select("row_id", "split", "prompt", "true_label")


@registry.add("split_without_key", f"WITH {KEYLESS_SQL} SELECT job_description_text, category_label, split FROM parts")
def split_without_key(spark, sf_dir):
    """Every row, told apart by content alone."""
    return S.split_rows(keyless_rows(spark, sf_dir), "category_label", None)
