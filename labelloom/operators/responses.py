"""Labelled text from delimited model responses.

A combination is a (category, language) pair. Requests are planned in rounds,
because how many rows are still needed depends on what earlier calls returned.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.functions import fixed_values as V
from labelloom.functions.hashing import DEFAULT_SEED, row_key
from labelloom.functions.text import strip
from labelloom.operators.generate import global_shuffle
from labelloom.plans.joins import lookup_join
from labelloom.plans.ledger import AT_ONCE, Ask, Ledger, record_calls
from labelloom.plans.ordering import first_in_order
from labelloom.plans.shared import Settled, settle
from labelloom.schemas import LABEL_COLUMN, TEXT_COLUMN

COMBINATION = ["category", "language"]


def combinations(categories: DataFrame, languages: list[str]) -> DataFrame:
    """Every category with every language name."""
    return categories.select("category", F.explode(F.array(*[F.lit(x) for x in languages])).alias("language"))


def request_plan(
    combos: DataFrame,
    n: int = V.RESPONSE_ROWS_PER_LANGUAGE,
    k: int = V.ROWS_PER_REQUEST,
    done: DataFrame | Settled | None = None,
    first_attempt: int = 1,
) -> DataFrame:
    """Requests that would complete every combination if all are answered in full.

    `done` has the rows made and the attempts used so far per combination. A
    combination stops at `n` rows or at `n // k + 3` attempts.
    """
    zero = F.lit(0).cast("bigint")
    if done is None:
        state = combos.select(*COMBINATION, zero.alias("made"), zero.alias("used"))
    else:
        known = lookup_join(combos, done, COMBINATION, COMBINATION)
        state = known.select(
            *COMBINATION, F.coalesce("made", zero).alias("made"), F.coalesce("used", zero).alias("used")
        )
    missing = F.lit(n) - F.col("made")
    budget = F.lit(n // k + V.EXTRA_ATTEMPTS) - F.col("used")
    calls = F.least(F.ceil(missing / k), budget).cast("bigint")
    open_ = state.withColumn("_calls", calls).filter(F.col("_calls") > 0)
    numbered = open_.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_calls") - 1)))
    attempt = (F.col("used") + F.col("_i") + 1).cast("bigint")
    return numbered.select(
        *COMBINATION,
        attempt.alias("attempt"),
        F.least(F.lit(k).cast("bigint"), F.lit(n) - F.col("made") - F.col("_i") * k).cast("bigint").alias("n_requested"),
        row_key("category", "language", attempt).alias("request_id"),
    )


def render_prompt(category: Column, language: Column, n: Column) -> Column:
    """Generation prompt inside the instruct wrapper."""
    template = V.REQUEST_WRAPPER.replace("{prompt}", V.REQUEST_PROMPT)
    values = {"{category}": category, "{language}": language, "{n}": n.cast("string")}
    # Cut once, so a value that looks like a slot stays as it is.
    pieces = re.split("(" + "|".join(map(re.escape, values)) + ")", template)
    return F.concat(*[values[p] if p in values else F.lit(p) for p in pieces])


def request_body(prompt: Column, n: Column) -> Column:
    return F.to_json(
        F.struct(
            prompt.alias("prompt"),
            (V.TOKENS_PER_ROW * n).cast("bigint").alias("max_gen_len"),
            F.lit(V.TEMPERATURE).alias("temperature"),
            F.lit(V.TOP_P).alias("top_p"),
        )
    )


def render_requests(plan: DataFrame) -> DataFrame:
    """Append `prompt` and `body` to a request plan."""
    n = F.col("n_requested")
    prompted = plan.withColumn("prompt", render_prompt(F.col("category"), F.col("language"), n))
    return prompted.withColumn("body", request_body(F.col("prompt"), n))


def call_model(
    requests: DataFrame, open_client: Callable[[], Callable[[str], str]], callers: int | None = None, ledger: Ledger | None = None,
    at_once: int = AT_ONCE,
) -> DataFrame:
    """One call per request, a client per task: the request's columns, `response` and `error`.

    Answers are written to a ledger as they come (default: a new one), under the request's id, and read from there
    when a task, or the result, is computed again; over the ledger of an earlier run only what it lacks is asked. A killed
    process can lose the `at_once` answers that it is gathering.
    Calls are slow and request tables small, so the requests are spread over
    `callers` tasks (default: the cluster's parallelism).
    A failing call gives its error instead of a response.
    """
    kept = [c for c in requests.columns if c not in ("prompt", "body")]
    text = T.StringType()

    def open_asker() -> Ask:
        client = None

        def one(body: str) -> tuple[str | None, str | None]:
            nonlocal client
            try:
                client = client or open_client()
                return client(body), None
            except Exception as problem:
                return None, str(problem)

        return lambda rows: [one(body) for (body,) in rows]

    spark = requests.sparkSession
    kept_in = ledger or Ledger.fresh(spark)
    answer = T.StructType([T.StructField("response", text), T.StructField("error", text)])
    answers = record_calls(requests, "request_id", ["body"], answer, open_asker, kept_in, at_once, callers)
    return requests.select(*[F.col(f"`{c}`") for c in kept]).join(answers, "request_id").select(*kept, "response", "error")


def extract_generation(body: Column) -> Column:
    """The `generation` field of a JSON response; null when absent."""
    return F.get_json_object(body, "$.generation")


def delimited_parts(text: Column, start: str = V.START_MARKER, end: str = V.END_MARKER) -> Column:
    """Non-empty stripped texts that an end marker closes; an unclosed last piece is dropped."""
    pieces = F.split(text, "\\Q" + start + "\\E")
    closed = F.filter(pieces, lambda p: F.contains(p, F.lit(end)))
    inner = F.transform(closed, lambda p: strip(F.substring_index(p, end, 1)))
    return F.filter(inner, lambda p: F.length(p) > 0)


def parse_delimited(
    responses: DataFrame, col: str, start: str = V.START_MARKER, end: str = V.END_MARKER
) -> DataFrame:
    """One row per delimited text: the other columns, `pos` and `text`."""
    others = [c for c in responses.columns if c != col]
    return responses.select(
        *others, F.posexplode(delimited_parts(F.col(col), start, end)).alias("pos", "text")
    )


def quota_cap(rows: DataFrame, group: list[str], order: list[str], n: int) -> DataFrame:
    """First `n` rows of each combination in arrival order; texts are not moved."""
    return first_in_order(rows, group, order, n)


def union_raw(*frames: DataFrame) -> DataFrame:
    """Raw rows of all sources; columns a source lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def generate_from_model(
    categories: DataFrame,
    open_client: Callable[[], Callable[[str], str]],
    languages: dict[str, str] | None = None,
    n: int = V.RESPONSE_ROWS_PER_LANGUAGE,
    k: int = V.ROWS_PER_REQUEST,
    seed: int = DEFAULT_SEED,
    ledger: Ledger | None = None,
) -> DataFrame:
    """Raw rows (text, label) made by a model, up to `n` per combination, in one seeded random order.

    All calls are kept in `ledger` (default: a new one); a run that is started again over it asks for what it lacks only.
    Each round asks for what is missing, writes the answers and counts again; there
    are at most `n // k + 3` rounds, and one when every answer is full.
    """
    combos = settle(combinations(categories, list(languages or V.RESPONSE_LANGUAGES)), "combinations").df
    ledger = ledger or Ledger.fresh(categories.sparkSession)
    rounds: list[DataFrame] = []
    done: Settled | None = None
    for _ in range(n // k + V.EXTRA_ATTEMPTS):
        plan = settle(request_plan(combos, n, k, done), "requests")
        if plan.rows == 0:
            break
        texts = delimited_parts(extract_generation(F.col("response")))
        answers = call_model(render_requests(plan.df), open_client, ledger=ledger).select(
            *COMBINATION, "attempt", F.coalesce(texts, F.array().cast("array<string>")).alias("texts")
        )
        rounds.append(settle(answers.withColumn("n_texts", F.size("texts").cast("bigint")), "answers").df)
        progress = union_raw(*rounds).groupBy(*COMBINATION).agg(
            F.least(F.sum("n_texts"), F.lit(n).cast("bigint")).alias("made"), F.max("attempt").alias("used")
        )
        done = settle(progress, "progress")
    if not rounds:
        return combos.select(
            F.lit("").alias(TEXT_COLUMN), F.col("category").alias(LABEL_COLUMN), "language"
        ).limit(0)
    rows = union_raw(*rounds).select(*COMBINATION, "attempt", F.posexplode("texts").alias("pos", "text"))
    kept = quota_cap(rows, COMBINATION, ["attempt", "pos"], n)
    named = kept.withColumn("_key", row_key(*COMBINATION, "attempt", "pos"))
    return global_shuffle(named, "_key", seed).select(
        F.col("text").alias(TEXT_COLUMN), F.col("category").alias(LABEL_COLUMN), "language"
    )
