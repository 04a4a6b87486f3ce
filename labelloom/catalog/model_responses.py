"""Model-response jobs: plan, prompt, call, parse, cap."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelloom.catalog.base import Registry, sql_strip, table
from labelloom.functions import fixed_values as V
from labelloom.operators import responses as L

registry = Registry()

LANGUAGES = ["English", "Spanish", "French"]
N, K, CAP = 50, 5, 7
START, END = V.START_MARKER, V.END_MARKER


def categories(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.col("source").alias("category")).distinct()


def plan(spark, sf_dir):
    return L.request_plan(L.combinations(categories(spark, sf_dir), LANGUAGES), N, K)


PLAN_SQL = f"""
plan AS (
  SELECT category, language, i + 1 AS attempt, least({K}, {N} - i * {K})::bigint AS n_requested,
         concat_ws('|', category, language, i + 1) AS request_id
  FROM (SELECT DISTINCT source AS category FROM documents),
       (SELECT unnest(['English', 'Spanish', 'French']) AS language), (SELECT unnest(range(0, {N // K})) AS i))"""

PROMPT_SQL = (
    "replace(replace(replace('"
    + V.REQUEST_WRAPPER.replace("{prompt}", V.REQUEST_PROMPT).replace("'", "''")
    + "', '{category}', category), '{language}', language), '{n}', n_requested::varchar)"
)


@registry.add("llm_request_plan", f"WITH {PLAN_SQL} SELECT * FROM plan")
def llm_request_plan(spark, sf_dir):
    return plan(spark, sf_dir)


@registry.add("llm_render_prompt", f"WITH {PLAN_SQL} SELECT request_id, {PROMPT_SQL} AS prompt FROM plan")
def llm_render_prompt(spark, sf_dir):
    return L.render_requests(plan(spark, sf_dir)).select("request_id", "prompt")


@registry.add("llm_request_body", f"""WITH {PLAN_SQL}
SELECT request_id, {PROMPT_SQL} AS prompt, 512 * n_requested AS max_gen_len, 0.75::double AS temperature,
       0.9::double AS top_p FROM plan""")
def llm_request_body(spark, sf_dir):
    body = F.from_json("body", "prompt string, max_gen_len bigint, temperature double, top_p double")
    return L.render_requests(plan(spark, sf_dir)).select("request_id", body.alias("b")).select("request_id", "b.*")


def echo_model():
    """Answers with two parts; refuses requests by a digest of the body."""

    def call(body):
        import hashlib
        import json

        asked = json.loads(body)
        if hashlib.md5(asked["prompt"].encode()).hexdigest()[0] < "3":
            raise RuntimeError("model refused")
        role = asked["prompt"].split('for the role of "')[1].split('"')[0]
        parts = [f"--- JD START ---\n{role} text {i}\n--- JD END ---\n" for i in (1, 2)]
        return json.dumps({"generation": "".join(parts)})

    return call


@registry.add("llm_call", f"""WITH {PLAN_SQL}, asked AS (SELECT *, md5({PROMPT_SQL}) < '3' AS refused FROM plan)
SELECT request_id, CASE WHEN refused THEN 'model refused' END AS error, CASE WHEN NOT refused THEN
         '{START}' || chr(10) || category || ' text 1' || chr(10) || '{END}' || chr(10) ||
         '{START}' || chr(10) || category || ' text 2' || chr(10) || '{END}' || chr(10) END AS generation FROM asked""")
def llm_call(spark, sf_dir):
    answers = L.call_model(L.render_requests(plan(spark, sf_dir)), echo_model)
    return answers.select("request_id", "error", L.extract_generation(F.col("response")).alias("generation"))


def responses(spark, sf_dir):
    """A response per document: several closed parts, an empty one, and at times an unclosed one."""
    shape = F.col("doc_id") % 5
    start, end = F.lit(START), F.lit(END)
    closed = F.concat(start, F.lit("\n"), F.col("text"), F.lit("\n"), end)
    small = F.concat(start, F.col("source"), end, F.lit(" junk "), end)
    empty = F.concat(start, F.lit(" \n "), end)
    generation = (
        F.when(shape == 0, F.concat(closed, small, empty))
        .when(shape == 1, F.concat(F.lit("stray "), end, closed, start, F.col("text")))
        .when(shape == 2, F.concat(start, F.col("text")))
        .when(shape == 3, F.concat(closed, F.lit("\n"), closed, F.lit("\n"), small))
        .otherwise(F.lit(""))
    )
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("request_id"),
        F.col("source").alias("category"),
        F.col("lang").alias("language"),
        F.to_json(F.struct(generation.alias("generation"), F.lit("stop").alias("stop_reason"))).alias("body"),
    )


CLOSED = f"'{START}' || chr(10) || text || chr(10) || '{END}'"
SMALL = f"'{START}' || source || '{END} junk {END}'"
RESPONSES_SQL = f"""
responses AS (
  SELECT doc_id AS request_id, source AS category, lang AS language, CASE doc_id % 5
    WHEN 0 THEN {CLOSED} || {SMALL} || '{START} ' || chr(10) || ' {END}'
    WHEN 1 THEN 'stray {END}' || {CLOSED} || '{START}' || text
    WHEN 2 THEN '{START}' || text
    WHEN 3 THEN {CLOSED} || chr(10) || {CLOSED} || chr(10) || {SMALL} ELSE '' END AS generation FROM documents)"""
PARSED_SQL = f"""{RESPONSES_SQL},
texts AS (
  SELECT request_id, category, language, list_filter(list_transform(
           list_filter(string_split(generation, '{START}'), lambda p: contains(p, '{END}')),
           lambda p: {sql_strip(f"string_split(p, '{END}')[1]")}), lambda p: length(p) > 0) AS t FROM responses),
parsed AS (
  SELECT request_id, category, language, pos, t[pos + 1] AS text
  FROM texts, LATERAL (SELECT unnest(range(0, len(t))) AS pos))"""


@registry.add("llm_extract_generation", f"WITH {RESPONSES_SQL} SELECT request_id, generation FROM responses")
def llm_extract_generation(spark, sf_dir):
    return responses(spark, sf_dir).select(
        "request_id", L.extract_generation(F.col("body")).alias("generation")
    )


def parsed(spark, sf_dir):
    texts = responses(spark, sf_dir).withColumn("generation", L.extract_generation(F.col("body"))).drop("body")
    return L.parse_delimited(texts, "generation").withColumn("pos", F.col("pos").cast("bigint"))


@registry.add("llm_parse_delimited", f"WITH {PARSED_SQL} SELECT request_id, pos, text FROM parsed")
def llm_parse_delimited(spark, sf_dir):
    return parsed(spark, sf_dir).select("request_id", "pos", "text")


@registry.add("llm_quota_cap", f"""WITH {PARSED_SQL}
SELECT request_id, category, language, pos, text FROM (
  SELECT *, row_number() OVER (PARTITION BY category, language ORDER BY request_id, pos) AS place FROM parsed)
WHERE place <= {CAP}""")
def llm_quota_cap(spark, sf_dir):
    return L.quota_cap(parsed(spark, sf_dir), L.COMBINATION, ["request_id", "pos"], CAP)


@registry.add("union_raw_sources", """
SELECT text AS job_description_text, source AS category_label, 'en' AS source_language, lang AS target_language
FROM documents
UNION ALL SELECT text, 'benchmark', NULL, NULL FROM benchmark""")
def union_raw_sources(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select(
        F.col("text").alias("job_description_text"), F.col("source").alias("category_label"),
        F.lit("en").alias("source_language"), F.col("lang").alias("target_language"),
    )
    answers = table(spark, sf_dir, "benchmark").select(
        F.col("text").alias("job_description_text"), F.lit("benchmark").alias("category_label")
    )
    return L.union_raw(documents, answers)


# The calls of a combination are told one after another: round by round, what is missing is asked for
# in full requests and a rest. An answered request gives two rows, a refused one none.
ROUNDS_SQL = f"""
WITH RECURSIVE combos AS (
  SELECT category, language FROM (SELECT DISTINCT source AS category FROM documents),
         (SELECT unnest(['English', 'Spanish', 'French']) AS language)),
rounds AS (
  SELECT category, language, 0 AS round, 0::bigint AS made, 0::bigint AS used, []::bigint[] AS given FROM combos
  UNION ALL
  SELECT category, language, round + 1, least({N}, made + coalesce(list_sum(got), 0))::bigint, used + calls,
         list_concat(given, got)
  FROM (
    SELECT *, list_transform(range(0, calls), lambda i:
      CASE WHEN md5(replace(replace(replace('{V.REQUEST_WRAPPER.replace("{prompt}", V.REQUEST_PROMPT).replace("'", "''")}',
             '{{category}}', category), '{{language}}', language), '{{n}}', least({K}, {N} - made - i * {K})::varchar)) < '3'
           THEN 0 ELSE 2 END::bigint) AS got
    FROM (SELECT *, least(ceil(({N} - made) / {K}::double)::bigint, {N // K + V.EXTRA_ATTEMPTS} - used) AS calls FROM rounds
          WHERE made < {N} AND used < {N // K + V.EXTRA_ATTEMPTS} AND round < {N // K + V.EXTRA_ATTEMPTS}))
  WHERE calls > 0),
last AS (SELECT category, language, arg_max(given, round) AS given FROM rounds GROUP BY ALL),
texts AS (
  SELECT category, language, category || ' text ' || unnest(flatten(list_transform(given, lambda g: range(1, g + 1)))) AS text,
         unnest(range(0, list_sum(given)::bigint)) AS place FROM last)
SELECT text AS job_description_text, category AS category_label, language FROM texts WHERE place < {N}"""


@registry.add("llm_generate_rounds", ROUNDS_SQL)
def llm_generate_rounds(spark, sf_dir):
    return L.generate_from_model(categories(spark, sf_dir), echo_model, {x: x for x in LANGUAGES}, n=N, k=K)
