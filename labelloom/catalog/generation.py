"""Generation: templates, variations, quotas, languages, translation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.catalog.base import Registry, sql_chance, sql_digest, sql_draw, sql_strip, table
from labelloom.functions import fixed_values as V
from labelloom.functions import text as X
from labelloom.functions.hashing import pick, row_key
from labelloom.operators import generate as G
from labelloom.operators import translate as R
from labelloom.plans.ledger import Ledger

registry = Registry()

N = 60
LANGUAGES = ["en", "es", "fr"]
SKILLS = {
    "src0": ["Python", "the", "R", "tools"],
    "src1": ["SQL", "e", "Spark"],
    "src2": ["REST APIs"],
    "src3": ["Six Sigma", "SEO/SEM"],
}


def templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`documents` as a template library (category = source), some with skill wording."""
    shape = F.col("doc_id") % 4
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        F.col("source").alias("category"),
        F.col("doc_id").alias("template_idx"),
        F.when(shape == 0, F.concat(text, F.lit(" Experience with tools. Experience with teams.")))
        .when(shape == 1, F.concat(F.lit("Good skills needed. "), text, F.lit(" More skills.")))
        .when(shape == 2, F.concat(F.lit("Skills: "), text))
        .otherwise(text).alias("template"),
    )


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources (with templates) and event types (without)."""
    sources = table(spark, sf_dir, "documents").select(F.col("source").alias("category"))
    types = table(spark, sf_dir, "events").select(F.col("event_type").alias("category"))
    return sources.unionByName(types).distinct()


def skills(spark: SparkSession) -> DataFrame:
    return G.skill_frame(spark, SKILLS)


TEMPLATES_SQL = """
templates AS (
  SELECT source AS category, doc_id AS template_idx,
         CASE doc_id % 4 WHEN 0 THEN text || ' Experience with tools. Experience with teams.'
              WHEN 1 THEN 'Good skills needed. ' || text || ' More skills.'
              WHEN 2 THEN 'Skills: ' || text ELSE text END AS template FROM documents)"""

PLAN_SQL = f"""{TEMPLATES_SQL},
plan AS (
  SELECT c.category, count(t.category) AS n_templates,
         CASE WHEN count(t.category) > 0 THEN {N} // count(t.category) + 1 ELSE {N} END::bigint AS variations
  FROM (SELECT source AS category FROM documents UNION SELECT event_type FROM events) c
  LEFT JOIN templates t ON t.category = c.category GROUP BY c.category)"""

EXPANDED_SQL = f"""{PLAN_SQL},
expanded AS (
  SELECT t.category, t.template_idx, t.template, v.variation,
         concat_ws('|', t.category, t.template_idx, v.variation) AS k
  FROM templates t JOIN plan p ON t.category = p.category,
       LATERAL (SELECT unnest(range(0, p.variations)) AS variation) v)"""


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def sql_pick(items: str, key: str, salt: str) -> str:
    return f"({items})[1 + {sql_draw(key, salt)} % len({items})]"


SKILL_CASE = "CASE category " + " ".join(f"WHEN '{c}' THEN {sql_list(s)}" for c, s in SKILLS.items()) + " END"


def sql_insert(text: str, skill: str) -> str:
    return f"""CASE WHEN {skill} IS NULL OR contains({text}, {skill}) THEN {text}
      WHEN contains({text}, 'Experience with')
        THEN regexp_replace({text}, 'Experience with', 'Experience with ' || {skill} || ' and')
      WHEN contains(lower({text}), 'skills') THEN regexp_replace({text}, 'skills', 'skills including ' || {skill})
      ELSE {text} || ' Proficiency in ' || {skill} || ' is beneficial.' END"""


def sql_prefix(sentences: str, category: str, key: str) -> str:
    verb = sql_pick(sql_list(V.ACTION_VERBS), key, "verb")
    company = sql_pick(sql_list(V.COMPANY_TYPES), key, "company")
    seniority = sql_pick(sql_list(V.SENIORITY_HINTS), key, "seniority")
    return f"""list_concat([CASE {sql_draw(key, 'prefix kind')} % 3
      WHEN 0 THEN 'Join ' || {company} || '. ' || {verb} || ' ' || {sentences}[1]
      WHEN 1 THEN {verb} || ' ' || {seniority} || ' ' || {category} || '. ' || {sentences}[1]
      ELSE {verb} || ' ' || {sentences}[1] END], {sentences}[2:])"""


def sql_shuffle(sentences: str, key: str) -> str:
    order = sql_digest(f"concat_ws('|', {key}, i)", "shuffle order")
    return f"""CASE WHEN len({sentences}) > 2 THEN list_concat([{sentences}[1]], list_transform(list_sort(
      list_transform(range(0, len({sentences}) - 2), lambda i: {{'d': {order}, 'i': i, 'x': {sentences}[i + 2]}})),
      lambda e: e.x), [{sentences}[-1]]) ELSE {sentences} END"""


def sql_suffix(text: str, key: str) -> str:
    return f"{sql_strip(text)} || ' (Job ID: ' || (10000 + {sql_draw(key, 'job id')} % 90000) || ')'"


VARIED_SQL = f"""{EXPANDED_SQL},
skilled AS (
  SELECT *, CASE WHEN {sql_chance('k', 'skill', 0.6)} THEN {sql_pick('skills', 'k', 'skill choice')} END AS skill,
         {sql_chance('k', 'prefix', 0.4)} AS prefixed, {sql_chance('k', 'shuffle', 0.3)} AS lucky
  FROM (SELECT *, {SKILL_CASE} AS skills, string_split(template, '. ') AS s0 FROM expanded)),
opened AS (SELECT *, CASE WHEN prefixed THEN {sql_prefix('s0', 'category', 'k')} ELSE s0 END AS s1 FROM skilled),
bodies AS (
  SELECT *, CASE WHEN len(s1) > 2 AND lucky THEN array_to_string({sql_shuffle('s1', 'k')}, '. ')
         WHEN prefixed THEN array_to_string(s1, '. ') ELSE {sql_insert('template', 'skill')} END AS body FROM opened),
varied AS (SELECT k AS text_key, category, {sql_suffix('body', 'k')} AS text FROM bodies)"""

GENERIC_SQL = f"""
generic0 AS (
  SELECT category, -1::bigint AS template_idx, unnest(range(0, {N}))::bigint AS variation
  FROM plan WHERE n_templates = 0),
generic AS (
  SELECT *, replace('{V.GENERIC_TEXT}', '{{category}}', category) || ' (Ref: GenericJD' || variation || '-' ||
         (1000 + {sql_draw("concat_ws('|', category, variation)", 'reference')} % 9000) || ')' AS text FROM generic0)"""

BASE_SQL = f"""{VARIED_SQL},{GENERIC_SQL},
base AS (
  SELECT text_key, category, text FROM (
    SELECT *, row_number() OVER (PARTITION BY category ORDER BY {sql_digest('text_key', 'quota')}, text_key) AS place
    FROM (SELECT * FROM varied UNION ALL
          SELECT concat_ws('|', category, template_idx, variation), category, text FROM generic))
  WHERE place <= {N})"""


@registry.add("gen_variation_plan", f"WITH {PLAN_SQL} SELECT category, n_templates, variations FROM plan")
def gen_variation_plan(spark, sf_dir):
    return G.variation_plan(templates(spark, sf_dir), categories(spark, sf_dir), N)


def expanded(spark, sf_dir):
    library = templates(spark, sf_dir)
    rows = G.expand(library, G.variation_plan(library, categories(spark, sf_dir), N))
    return rows.withColumn("text_key", row_key("category", "template_idx", "variation"))


@registry.add("gen_expand", f"WITH {EXPANDED_SQL} SELECT category, template_idx, variation, template FROM expanded")
def gen_expand(spark, sf_dir):
    return expanded(spark, sf_dir).select("category", "template_idx", "variation", "template")


@registry.add("gen_generic_fallback", f"WITH {PLAN_SQL},{GENERIC_SQL} SELECT category, variation, text FROM generic")
def gen_generic_fallback(spark, sf_dir):
    plan = G.variation_plan(templates(spark, sf_dir), categories(spark, sf_dir), N)
    return G.generic_fallback(plan, N).select("category", "variation", "text")


@registry.add("gen_insert_skill", f"""WITH {TEMPLATES_SQL},
chosen AS (
  SELECT *, {sql_pick('skills', 'template_idx', 'skill choice')} AS skill
  FROM (SELECT *, {SKILL_CASE} AS skills FROM templates))
SELECT template_idx, skill, {sql_insert('template', 'skill')} AS text FROM chosen""")
def gen_insert_skill(spark, sf_dir):
    rows = templates(spark, sf_dir).join(F.broadcast(skills(spark)), "category", "left")
    chosen = rows.withColumn("skill", pick(F.col("skills"), "template_idx", "skill choice"))
    return chosen.select(
        "template_idx", "skill", G.insert_skill(F.col("template"), F.col("skill")).alias("text")
    )


@registry.add("gen_prefix_context", f"""WITH {TEMPLATES_SQL}
SELECT template_idx, array_to_string({sql_prefix('s', 'category', 'template_idx')}, '. ') AS text
FROM (SELECT *, string_split(template, '. ') AS s FROM templates)""")
def gen_prefix_context(spark, sf_dir):
    sentences = G.prefix_context(X.split_sentences(F.col("template")), F.col("category"), F.col("template_idx"))
    return templates(spark, sf_dir).select("template_idx", F.array_join(sentences, ". ").alias("text"))


@registry.add("gen_shuffle_middle", f"""WITH {TEMPLATES_SQL}
SELECT template_idx, array_to_string({sql_shuffle('s', 'template_idx')}, '. ') AS text
FROM (SELECT *, string_split(template, '. ') AS s FROM templates)""")
def gen_shuffle_middle(spark, sf_dir):
    sentences = G.shuffle_middle(X.split_sentences(F.col("template")), F.col("template_idx"))
    return templates(spark, sf_dir).select("template_idx", F.array_join(sentences, ". ").alias("text"))


@registry.add("split_sentences", """
SELECT row_id, pos, s[pos + 1] AS sentence
FROM (SELECT doc_id AS row_id, string_split(text, '. ') AS s FROM documents),
     LATERAL (SELECT unnest(range(0, len(s))) AS pos)""")
def split_sentences(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"), F.posexplode(X.split_sentences(F.col("text"))).alias("pos", "sentence")
    ).withColumn("pos", F.col("pos").cast("bigint"))


@registry.add("gen_unique_suffix", f"""
SELECT doc_id AS row_id, {sql_suffix("chr(160) || text || chr(10)", 'doc_id')} AS text FROM documents""")
def gen_unique_suffix(spark, sf_dir):
    padded = F.concat(F.lit("\u00a0"), F.col("text"), F.lit("\n"))
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"), G.unique_suffix(padded, F.col("doc_id")).alias("text")
    )


def base(spark, sf_dir):
    return G.base_texts(templates(spark, sf_dir), categories(spark, sf_dir), skills(spark), N)


@registry.add("gen_texts", f"WITH {VARIED_SQL} SELECT text_key, category, text FROM varied")
def gen_texts(spark, sf_dir):
    return G.vary(expanded(spark, sf_dir), skills(spark), "text_key").select("text_key", "category", "text")


@registry.add("gen_quota_shared_base", f"WITH {BASE_SQL} SELECT text_key, category, text FROM base")
def gen_quota_shared_base(spark, sf_dir):
    return base(spark, sf_dir)


@registry.add("gen_language_rows", f"""WITH {BASE_SQL}
SELECT text_key, category, 'en' AS source_language, target_language
FROM base, (SELECT unnest({sql_list(LANGUAGES)}) AS target_language)""")
def gen_language_rows(spark, sf_dir):
    return G.language_rows(base(spark, sf_dir), LANGUAGES).drop("text")


# --- translation ---

# A phrase memory over the documents: half of the texts are translated, a quarter failed, the rest are unknown.
FOREIGN_SQL = """
foreign_rows AS (
  SELECT doc_id || '|' || target_language AS row_key, text, target_language
  FROM documents, (SELECT unnest(['en', 'es', 'fr']) AS target_language))"""
MEMORY_SQL = f"""{FOREIGN_SQL},
attempted AS (
  SELECT *, CASE WHEN target_language = 'en' THEN 'passed' WHEN md5(text) < '8' THEN 'translated'
            WHEN md5(text) < 'c' THEN 'failed' ELSE 'error' END AS status FROM foreign_rows),
outcomes AS (
  SELECT *, CASE status WHEN 'failed' THEN 'ThrottlingException' END AS error_code,
         CASE status WHEN 'failed' THEN 'Rate exceeded' WHEN 'error' THEN 'no such phrase' END AS message,
         CASE status WHEN 'translated' THEN target_language || '> ' || text END AS translated FROM attempted)"""


def foreign_rows(spark, sf_dir):
    rows = G.language_rows(table(spark, sf_dir, "documents"), LANGUAGES)
    return rows.select(row_key("doc_id", "target_language").alias("row_key"), "text", "target_language")


def memory(spark, sf_dir):
    code = F.md5("text")
    texts = table(spark, sf_dir, "documents").filter(code < "c").select("text").distinct()
    done = code < "8"
    return G.language_rows(texts, LANGUAGES).filter("target_language <> 'en'").select(
        F.col("text").alias("source_text"),
        "target_language",
        F.when(done, F.concat(F.col("target_language"), F.lit("> "), F.col("text"))).alias("translated"),
        F.when(~done, V.THROTTLED).alias("error_code"),
        F.when(~done, "Rate exceeded").alias("message"),
    )


def outcomes(spark, sf_dir):
    return R.translate_from_memory(foreign_rows(spark, sf_dir), memory(spark, sf_dir), "row_key")


@registry.add("enrich_translate", f"""WITH {MEMORY_SQL}
SELECT row_key, target_language, status, error_code, message, translated FROM outcomes""")
def enrich_translate(spark, sf_dir):
    return outcomes(spark, sf_dir).drop("text")


@registry.add("enrich_failure_marker", f"""WITH {MEMORY_SQL}
SELECT row_key, target_language, CASE status WHEN 'translated' THEN translated
       WHEN 'failed' THEN '[' || upper(target_language) || '_FAILED_' || error_code || '] ' || text
       WHEN 'error' THEN '[' || upper(target_language) || '_ERROR] ' || text ELSE text END AS text FROM outcomes""")
def enrich_failure_marker(spark, sf_dir):
    return R.mark_failures(outcomes(spark, sf_dir)).select("row_key", "target_language", "text")


@registry.add("enrich_no_client", f"""WITH {MEMORY_SQL}
SELECT row_key, CASE WHEN target_language = 'en' THEN text ELSE '[' || upper(target_language) || '_NO_CLIENT] ' || text
       END AS text FROM foreign_rows""")
def enrich_no_client(spark, sf_dir):
    return R.mark_failures(R.no_client(foreign_rows(spark, sf_dir))).select("row_key", "text")


class Refused(Exception):
    code = V.THROTTLED


def echo_client():
    """A client that succeeds, is throttled for good, or breaks, by the text's digest."""

    class Refused(Exception):
        code = "ThrottlingException"

    def call(text, source, target):
        import hashlib

        first = hashlib.md5(text.encode()).hexdigest()[0]
        if first < "8":
            return f"{target}> {text}"
        if first < "c":
            raise Refused("Rate exceeded")
        raise RuntimeError("no such phrase")

    return call


def no_wait(seconds):
    return None


@registry.add("enrich_translate_with_client", f"""WITH {MEMORY_SQL}
SELECT row_key, target_language, status, error_code, message, translated FROM outcomes""")
def enrich_translate_with_client(spark, sf_dir):
    step = R.translate_with(echo_client, wait=no_wait)
    return step(foreign_rows(spark, sf_dir)).drop("text")


def client_run(spark, sf_dir):
    step = R.translate_with(echo_client, wait=no_wait)
    return G.generate_run(templates(spark, sf_dir), categories(spark, sf_dir), LANGUAGES, N, SKILLS, step)


RUN_SQL = f"""{BASE_SQL},
called AS (
  SELECT *, CASE WHEN target_language = 'en' THEN 'passed' WHEN md5(text) < '8' THEN 'translated'
                 WHEN md5(text) < 'c' THEN 'failed' ELSE 'error' END AS status
  FROM (SELECT category, text, unnest({sql_list(LANGUAGES)}) AS target_language FROM base))"""


@registry.add("generate_raw_with_client", f"""WITH {RUN_SQL}
SELECT CASE status WHEN 'passed' THEN text WHEN 'translated' THEN target_language || '> ' || text
            WHEN 'failed' THEN '[' || upper(target_language) || '_FAILED_ThrottlingException] ' || text
            ELSE '[' || upper(target_language) || '_ERROR] ' || text END AS job_description_text,
       category AS category_label, 'en' AS source_language, target_language FROM called""")
def generate_raw_with_client(spark, sf_dir):
    return client_run(spark, sf_dir).rows


@registry.add("generate_run_statistics", f"""WITH {RUN_SQL},
sums AS (
  SELECT count(*) FILTER (WHERE status <> 'passed') AS tried, count(*) FILTER (WHERE status = 'translated') AS good,
         count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status = 'error') AS broken FROM called)
SELECT 'attempted' AS key, tried AS n FROM sums UNION ALL SELECT 'successful', good FROM sums
UNION ALL SELECT 'failed', failed + broken FROM sums
UNION ALL SELECT 'ThrottlingException: Rate exceeded', failed FROM sums WHERE failed > 0
UNION ALL SELECT 'UnknownError: no such phrase', broken FROM sums WHERE broken > 0""")
def generate_run_statistics(spark, sf_dir):
    """Statistics and error kinds of the run that makes the rows."""
    run = client_run(spark, sf_dir)
    totals = F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).alias("n")) for c in ("attempted", "successful", "failed")])
    counted = run.statistics.select(F.inline(totals))
    return counted.unionByName(run.errors.select(F.col("error_type").alias("key"), "n"))


ATTEMPTS_SQL = """
attempts AS (
  SELECT event_id // 3 AS item_id, event_id % 3 AS attempt,
         CASE WHEN event_type IN ('error', 'view', 'click') THEN 'failure' ELSE 'success' END AS status,
         CASE event_type WHEN 'error' THEN 'ThrottlingException' WHEN 'view' THEN 'UnsupportedLanguagePairException'
              END AS error_code,
         CASE event_type WHEN 'error' THEN 'Rate exceeded' WHEN 'view' THEN 'bad pair' WHEN 'click' THEN 'timeout'
              END AS message FROM events),
finals AS (
  SELECT item_id, min(attempt) FILTER (
           WHERE status = 'success' OR error_code IS NULL OR error_code <> 'ThrottlingException' OR attempt >= 2) AS final,
         max(attempt) AS last FROM attempts GROUP BY item_id),
retried AS (
  SELECT f.item_id, coalesce(final, last) + 1 AS n_attempts,
         CASE WHEN final IS NULL THEN 'pending' WHEN status = 'success' THEN 'translated'
              WHEN error_code IS NOT NULL THEN 'failed' ELSE 'error' END AS status, error_code, message,
         (2 * (pow(2, coalesce(final, last) + CASE WHEN final IS NULL THEN 1 ELSE 0 END) - 1))::bigint AS waited_seconds
  FROM finals f JOIN attempts a ON a.item_id = f.item_id AND a.attempt = coalesce(final, last))"""


def attempts(spark, sf_dir):
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.expr("event_id div 3").alias("item_id"),
        (F.col("event_id") % 3).alias("attempt"),
        F.when(kind.isin("error", "view", "click"), "failure").otherwise("success").alias("status"),
        F.when(kind == "error", V.THROTTLED).when(kind == "view", "UnsupportedLanguagePairException").alias("error_code"),
        F.when(kind == "error", "Rate exceeded").when(kind == "view", "bad pair")
        .when(kind == "click", "timeout").alias("message"),
    )


@registry.add("retry_outcome", f"""WITH {ATTEMPTS_SQL}
SELECT item_id, n_attempts, status, error_code, message, waited_seconds FROM retried""")
def retry_outcome(spark, sf_dir):
    return R.retry_outcome(attempts(spark, sf_dir))


# A client that throttles some texts once, twice or always, by the first digit of their digest.
class Unsupported(Exception):
    code = "UnsupportedLanguagePairException"


def moody_client(round_):
    def call(text, source, target):
        import hashlib

        first = hashlib.md5(text.encode()).hexdigest()[0]
        if round_ < {"8": 1, "9": 1, "a": 2, "b": 3}.get(first, 0):
            raise Refused("Rate exceeded")
        if first in "cd":
            raise Unsupported("bad pair")
        if first in "ef":
            raise RuntimeError("no such phrase")
        return f"{target}> {text}"

    return call


LOG_SQL = f"""{FOREIGN_SQL},
kinds AS (
  SELECT *, substring(md5(text), 1, 1) AS h,
         CASE substring(md5(text), 1, 1) WHEN '8' THEN 1 WHEN '9' THEN 1 WHEN 'a' THEN 2 WHEN 'b' THEN 3 ELSE 0 END AS throttled
  FROM foreign_rows WHERE target_language <> 'en'),
log AS (
  SELECT row_key AS item_id, attempt, CASE WHEN attempt < throttled OR h >= 'c' THEN 'failure' ELSE 'success' END AS status,
         CASE WHEN attempt < throttled THEN 'ThrottlingException' WHEN h IN ('c', 'd') THEN 'UnsupportedLanguagePairException' END AS error_code,
         CASE WHEN attempt < throttled THEN 'Rate exceeded' WHEN h IN ('c', 'd') THEN 'bad pair' WHEN h >= 'e' THEN 'no such phrase' END AS message,
         CASE WHEN attempt >= throttled AND h < 'c' THEN target_language || '> ' || text END AS translated
  FROM (SELECT *, unnest(range(0, least(throttled, 2) + 1)) AS attempt FROM kinds)),
ended AS (
  SELECT item_id, attempt + 1 AS n_attempts, CASE WHEN status = 'success' THEN 'translated' WHEN error_code IS NULL THEN 'error'
         ELSE 'failed' END AS status, error_code, message, translated, (2 * (pow(2, attempt) - 1))::bigint AS waited_seconds
  FROM log QUALIFY attempt = max(attempt) OVER (PARTITION BY item_id))"""


def attempted(spark, sf_dir):
    return R.attempt_in_rounds(foreign_rows(spark, sf_dir), moody_client, wait=no_wait)


@registry.add("attempt_log", f"WITH {LOG_SQL} SELECT item_id, attempt, status, error_code, message, translated FROM log")
def attempt_log(spark, sf_dir):
    """Every attempt of a translation run in rounds."""
    return attempted(spark, sf_dir).log


@registry.add("retry_outcome_of_log", f"WITH {LOG_SQL} SELECT item_id, n_attempts, status, error_code, message, waited_seconds FROM ended")
def retry_outcome_of_log(spark, sf_dir):
    """What the library's own log of attempts comes to."""
    return R.retry_outcome(attempted(spark, sf_dir).log)


@registry.add("translate_in_rounds", f"""WITH {LOG_SQL}
SELECT row_key, target_language, 'passed' AS status, NULL::varchar AS error_code, NULL::varchar AS message, NULL::varchar AS translated
FROM foreign_rows WHERE target_language = 'en'
UNION ALL SELECT row_key, target_language, ended.status, error_code, message, translated
FROM foreign_rows JOIN ended ON item_id = row_key WHERE target_language <> 'en'""")
def translate_in_rounds(spark, sf_dir):
    return attempted(spark, sf_dir).outcomes.drop("text")


def dated_client(name):
    def open_client(round_):
        return lambda text, source, target: f"{name} {target}> {text}"

    return open_client


@registry.add("translate_resumed", f"""WITH {FOREIGN_SQL}
SELECT row_key, CASE WHEN target_language = 'en' THEN NULL WHEN md5(row_key) < '8' THEN 'early ' || target_language || '> ' || text
                     ELSE 'late ' || target_language || '> ' || text END AS translated FROM foreign_rows""")
def translate_resumed(spark, sf_dir):
    """A run over a ledger that an earlier run filled in part: what it has is not asked for again."""
    rows = foreign_rows(spark, sf_dir)
    ledger = Ledger.fresh(spark)
    R.attempt_in_rounds(rows.filter(F.md5("row_key") < "8"), dated_client("early"), wait=no_wait, ledger=ledger)
    return R.attempt_in_rounds(rows, dated_client("late"), wait=no_wait, ledger=ledger).outcomes.select("row_key", "translated")


@registry.add("translation_stats", f"""WITH {ATTEMPTS_SQL}
SELECT attempted, successful, attempted - successful AS failed,
       CASE WHEN successful > 0 THEN round(successful / attempted * 100, 6) END AS success_rate
FROM (SELECT count(*) FILTER (WHERE status IN ('translated', 'failed', 'error')) AS attempted,
             count(*) FILTER (WHERE status = 'translated') AS successful FROM retried)""")
def translation_stats(spark, sf_dir):
    stats = R.translation_stats(R.retry_outcome(attempts(spark, sf_dir)))
    return stats.withColumn("success_rate", F.round("success_rate", 6))


@registry.add("translation_error_histogram", f"""WITH {ATTEMPTS_SQL}
SELECT coalesce(error_code, 'UnknownError') || ': ' || coalesce(message, '') AS error_type, count(*) AS n
FROM retried WHERE status IN ('failed', 'error') GROUP BY 1""")
def translation_error_histogram(spark, sf_dir):
    return R.error_histogram(R.retry_outcome(attempts(spark, sf_dir)))


@registry.add("generation_counts", f"""WITH {PLAN_SQL},
made AS (SELECT source AS category, lang AS target_language, count(*) AS generated FROM documents GROUP BY ALL)
SELECT category, target_language, coalesce(generated, 0)::bigint AS generated,
       greatest({N} - coalesce(generated, 0), 0)::bigint AS shortfall
FROM (SELECT category, target_language FROM plan, (SELECT unnest({sql_list(LANGUAGES)}) AS target_language))
LEFT JOIN made USING (category, target_language)""")
def generation_counts(spark, sf_dir):
    made = table(spark, sf_dir, "documents").select(
        F.col("source").alias("category"), F.col("lang").alias("target_language")
    )
    return G.generation_counts(made, categories(spark, sf_dir), LANGUAGES, N)


@registry.add("global_shuffle", f"""
SELECT doc_id AS row_id, text, row_number() OVER (ORDER BY {sql_digest('doc_id', 'global shuffle')}, doc_id)
       AS shuffle_position FROM documents""")
def global_shuffle(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), "text")
    return G.numbered_shuffle(rows, "row_id")


@registry.add("generate_raw", f"""WITH {BASE_SQL}
SELECT CASE WHEN target_language = 'en' THEN text ELSE '[' || upper(target_language) || '_NO_CLIENT] ' || text END
       AS job_description_text, category AS category_label, 'en' AS source_language, target_language
FROM base, (SELECT unnest({sql_list(LANGUAGES)}) AS target_language)""")
def generate_raw(spark, sf_dir):
    return G.generate_raw(templates(spark, sf_dir), categories(spark, sf_dir), LANGUAGES, N, SKILLS)


@registry.add("parse_language_list", f"""
SELECT row_id, array_to_string(list_transform(string_split(option, ','), lambda x: {sql_strip('x')}), '/') AS codes,
       array_to_string(list_transform(string_split(pairs, ','),
         lambda x: {sql_strip("string_split(x, ':')[1]")} || '=' || {sql_strip("string_split(x, ':')[2]")}), '/') AS pairs
FROM (SELECT doc_id AS row_id, 'en, ' || lang || ' ,' || source AS option,
             'English:en, ' || source || ' : ' || lang AS pairs FROM documents)""")
def parse_language_list(spark, sf_dir):
    options = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"),
        F.concat(F.lit("en, "), F.col("lang"), F.lit(" ,"), F.col("source")).alias("option"),
        F.concat(F.lit("English:en, "), F.col("source"), F.lit(" : "), F.col("lang")).alias("pairs"),
    )
    shown = F.transform(
        X.parse_language_pairs(F.col("pairs")), lambda p: F.concat(p["name"], F.lit("="), p["code"])
    )
    return options.select(
        "row_id",
        F.array_join(X.parse_language_list(F.col("option")), "/").alias("codes"),
        F.array_join(shown, "/").alias("pairs"),
    )
