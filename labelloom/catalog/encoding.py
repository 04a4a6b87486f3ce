"""Encoding: chat templates, token arrays, masks, labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelloom.catalog.base import RAW_SQL, Registry, raw_rows, sql_clean, sql_digest, sql_split, sql_squeeze, table
from labelloom.catalog.preparation import MESSAGE_SQL, message_rows
from labelloom.operators import encode as C
from labelloom.operators import prepare as P
from labelloom.operators import score as M
from labelloom.operators import split as S

registry = Registry()

EOS = "<eos>"
SHORT = 32

HUMAN = "chr(10) || chr(10) || 'Human: '"
ASSISTANT = "chr(10) || chr(10) || 'Assistant: '"


def rendered_sql(eos: str, system: str, tail: str) -> str:
    user = f"{HUMAN} || prompt || '{eos}'"
    answer = f"{ASSISTANT} || lang || '{eos}'"
    follow = f"{HUMAN} || source || '{eos}'"
    return f"""CASE shape WHEN 0 THEN {user} || {answer} WHEN 1 THEN {system} || {user} || {answer}
       WHEN 2 THEN {user} ELSE {user} || {answer} || {follow} || {answer} END || {tail}"""


@registry.add("render_chat_train", f"WITH {MESSAGE_SQL} SELECT row_id, {rendered_sql(EOS, chr(39) * 2, chr(39) * 2)} AS text FROM base")
def render_chat_train(spark, sf_dir):
    return message_rows(spark, sf_dir).select("row_id", C.render_train(F.col("messages"), EOS).alias("text"))


@registry.add("render_chat_eval", f"WITH {MESSAGE_SQL} SELECT row_id, {rendered_sql(EOS, 'system', ASSISTANT)} AS text FROM base")
def render_chat_eval(spark, sf_dir):
    return message_rows(spark, sf_dir).select("row_id", C.render_eval(F.col("messages"), EOS).alias("text"))


# Word tokens: the end marker is set off by a blank, so that it is a word of its own.
END_WORD = " " + EOS


def vocabulary(spark, sf_dir):
    return C.word_vocabulary(table(spark, sf_dir, "benchmark"), "text", EOS)


def encoded(spark, sf_dir, limit, pad=True):
    rows = message_rows(spark, sf_dir).withColumn("text", C.render_train(F.col("messages"), END_WORD))
    return C.encode(rows.select("row_id", "text"), "text", vocabulary(spark, sf_dir), "row_id", limit, pad)


VOCABULARY_SQL = f"""
counted AS (
  SELECT word, count(*) AS n FROM (SELECT unnest(string_split({sql_squeeze('text')}, ' ')) AS word FROM benchmark)
  WHERE word <> '' AND word <> '{EOS}' GROUP BY word),
words AS (
  SELECT word, (row_number() OVER (ORDER BY n DESC, word) + 1)::integer AS token_id FROM counted
  UNION ALL SELECT '{EOS}', 1)"""


def encoded_sql(source: str, limit: int) -> str:
    """CTEs ending in `encoded(row_id, n_tokens, ids)` over `source(row_id, text)`."""
    return f"""{VOCABULARY_SQL},
listed AS (SELECT row_id, string_split({sql_squeeze('text')}, ' ')[1:{limit}] AS w FROM {source}),
tokens AS (
  SELECT row_id, pos, w[pos] AS word FROM listed, LATERAL (SELECT unnest(range(1, len(w) + 1)) AS pos)),
encoded AS (
  SELECT row_id, count(*) AS n_tokens, list(coalesce(token_id, 0) ORDER BY pos) AS ids
  FROM tokens LEFT JOIN words USING (word) GROUP BY row_id)"""


TEXTS_SQL = f"{MESSAGE_SQL}, texts AS (SELECT row_id, {rendered_sql(END_WORD, chr(39) * 2, chr(39) * 2)} AS text FROM base)"


def joined(ids: str) -> str:
    return f"array_to_string({ids}, ' ')"


def padded_sql(limit: str) -> str:
    return f"list_concat(ids, list_transform(range(0, {limit} - n_tokens), lambda i: 1))"


def tokens_sql(limit: int) -> str:
    return f"""WITH {TEXTS_SQL},{encoded_sql('texts', limit)}
SELECT row_id, n_tokens, {joined(padded_sql(str(limit)))} AS input_ids FROM encoded"""


def show(ids: str):
    return F.array_join(F.transform(ids, lambda x: x.cast("string")), " ").alias(ids)


@registry.add("tokenize_pad", tokens_sql(512))
def tokenize_pad(spark, sf_dir):
    return encoded(spark, sf_dir, 1024).select("row_id", "n_tokens", show("input_ids"))


@registry.add("tokenize_pad_short", tokens_sql(SHORT))
def tokenize_pad_short(spark, sf_dir):
    return encoded(spark, sf_dir, SHORT).select("row_id", "n_tokens", show("input_ids"))


@registry.add("attention_mask", f"""WITH {TEXTS_SQL},{encoded_sql('texts', 512)}
SELECT row_id, {joined("list_transform(range(0, 512), lambda i: (i < n_tokens)::integer)")} AS attention_mask FROM encoded""")
def attention_mask(spark, sf_dir):
    mask = C.attention_mask(F.col("n_tokens"), F.lit(C.token_limit(512)))
    return encoded(spark, sf_dir, 512, pad=False).withColumn("attention_mask", mask).select(
        "row_id", show("attention_mask")
    )


@registry.add("causal_lm_labels", f"""WITH {TEXTS_SQL},{encoded_sql('texts', SHORT)}
SELECT row_id, {joined(f"list_transform({padded_sql(str(SHORT))}, lambda x: CASE WHEN x = 1 THEN -100 ELSE x END)")} AS labels
FROM encoded""")
def causal_lm_labels(spark, sf_dir):
    rows = encoded(spark, sf_dir, SHORT).withColumn("labels", C.causal_labels(F.col("input_ids")))
    return rows.select("row_id", show("labels"))


def test_prompts(spark, sf_dir):
    """The test part with its evaluation prompt."""
    parts = S.split_rows(raw_rows(spark, sf_dir), "category_label", "row_id").filter("split = 'test'")
    rows = P.prompt_and_label(P.to_messages(parts))
    user = F.slice("messages", 1, 1)
    return rows.select("row_id", "true_label", C.render_eval(user, EOS).alias("prompt"))


PREFIX_SQL = "'Classify the following job description. Job Description: '"
PROMPTS_SQL = f"""{RAW_SQL},{sql_split('raw')},
prompts AS (
  SELECT row_id, category_label AS true_label,
         {HUMAN} || {PREFIX_SQL} || {sql_clean('job_description_text')} || '{EOS}' || {ASSISTANT} AS prompt
  FROM parts WHERE split = 'test'),
batched AS (
  SELECT *, (row_number() OVER (ORDER BY {sql_digest('row_id', 'split')}, row_id) - 1) // 4 AS batch_id FROM prompts)"""


@registry.add("tokenize_batch_longest", f"""WITH {PROMPTS_SQL},
texts AS (SELECT row_id, prompt AS text FROM prompts),{encoded_sql('texts', 512)},
sized AS (SELECT e.*, batch_id, max(n_tokens) OVER (PARTITION BY batch_id) AS longest FROM encoded e JOIN batched USING (row_id))
SELECT row_id, batch_id, {joined(padded_sql('longest'))} AS input_ids,
       {joined("list_transform(range(0, longest), lambda i: (i < n_tokens)::integer)")} AS attention_mask FROM sized""")
def tokenize_batch_longest(spark, sf_dir):
    batched = M.assign_batches(test_prompts(spark, sf_dir), "row_id", 4)
    rows = C.encode(batched, "prompt", vocabulary(spark, sf_dir), "row_id", pad=False)
    return C.pad_batches(rows).select("row_id", "batch_id", show("input_ids"), show("attention_mask"))


@registry.add("assign_batches", f"WITH {PROMPTS_SQL} SELECT row_id, batch_id FROM batched")
def assign_batches(spark, sf_dir):
    return M.assign_batches(test_prompts(spark, sf_dir), "row_id", 4).select("row_id", "batch_id")
