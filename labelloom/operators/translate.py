"""Translation of generated rows: phrase memory, user translator, outcomes, statistics.

A translated row has `status` (passed, no_client, translated, failed, error),
`error_code`, `message` and `translated`; `mark_failures` turns these into the
final `text`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.functions import fixed_values as V
from labelloom.plans.joins import lookup_join
from labelloom.plans.ledger import AT_ONCE, Ask, Ledger, settle_calls, tasks_for, with_answers
from labelloom.plans.shared import Settled, measure, settle

OUTCOME = ["status", "error_code", "message", "translated"]


def _foreign() -> Column:
    return F.col("target_language") != V.SOURCE_LANGUAGE


def no_client(rows: DataFrame) -> DataFrame:
    """Outcome columns for a run without a translator."""
    nothing = F.lit(None).cast("string")
    return rows.select(
        "*",
        F.when(_foreign(), "no_client").otherwise("passed").alias("status"),
        nothing.alias("error_code"),
        nothing.alias("message"),
        nothing.alias("translated"),
    )


def translate_from_memory(rows: DataFrame, memory: DataFrame, row_key: str) -> DataFrame:
    """Look every foreign row up in a phrase memory.

    `memory` has (source_text, target_language, translated, error_code, message),
    one row per text and language; a text that is not there is an error. Texts are known by
    digest and length, and do not go through the join.
    """
    texts = memory.select(
        F.sha2("source_text", 256).alias("_digest"),
        "target_language",
        F.length("source_text").alias("_length"),
        F.col("translated").alias("_translated"),
        F.col("error_code").alias("_code"),
        F.col("message").alias("_message"),
    )
    # Rows in the source language need no lookup and stay where they are; those without a language match nothing.
    foreign = F.coalesce(_foreign(), F.lit(True))
    keyed = rows.filter(foreign).withColumn("_digest", F.when(_foreign(), F.sha2("text", 256)))
    looked_up = lookup_join(keyed, settle(texts, "memory"), ["_digest", "target_language"], [row_key])
    found = looked_up.unionByName(rows.filter(~foreign), allowMissingColumns=True)
    hit = F.col("_length") == F.length("text")
    status = (
        F.when(~_foreign(), "passed")
        .when(hit & F.col("_translated").isNotNull(), "translated")
        .when(hit & F.col("_code").isNotNull(), "failed")
        .otherwise("error")
    )
    marked = found.withColumn("status", status)
    return marked.select(
        *[F.col(f"`{c}`") for c in rows.columns],
        "status",
        F.when(F.col("status") == "failed", F.col("_code")).alias("error_code"),
        F.when(F.col("status") == "failed", F.col("_message"))
        .when(F.col("status") == "error", "no such phrase").alias("message"),
        F.when(F.col("status") == "translated", F.col("_translated")).alias("translated"),
    )


def translate_with(
    open_client: Callable[[], Callable[[str, str, str], str]],
    error_code: Callable[[Exception], str | None] = lambda e: getattr(e, "code", None),
    wait: Callable[[float], None] | None = None,
    attempts: int = V.MAX_TRANSLATION_ATTEMPTS,
) -> Callable[[DataFrame], DataFrame]:
    """A translation step around a user's client.

    `open_client()` runs once per partition and returns `f(text, source, target)`.
    An exception with error code `ThrottlingException` is retried after 2 s, then
    4 s, in its task (`translate_in_rounds` does not hold up other rows, and logs); any other ends the row. A coded exception is a failure, an uncoded one an
    error.
    """
    throttled, first_wait, source = V.THROTTLED, V.FIRST_RETRY_WAIT_SECONDS, V.SOURCE_LANGUAGE

    def step(rows: DataFrame) -> DataFrame:
        schema = T.StructType(rows.schema.fields + [T.StructField(c, T.StringType()) for c in OUTCOME])

        def one(client, text, target):
            import time

            pause = wait or time.sleep
            for attempt in range(attempts):
                try:
                    return "translated", None, None, client(text, source, target)
                except Exception as problem:
                    code = error_code(problem)
                    if code == throttled and attempt < attempts - 1:
                        pause(first_wait * 2**attempt)
                        continue
                    return ("failed" if code else "error"), code, str(problem), None

        def run(batches: Iterator) -> Iterator:
            client = None
            for batch in batches:
                outcomes = []
                for text, target in zip(batch["text"], batch["target_language"]):
                    if target == source:
                        outcomes.append(("passed", None, None, None))
                    else:
                        client = client or open_client()
                        outcomes.append(one(client, text, target))
                for at, name in enumerate(["status", "error_code", "message", "translated"]):
                    batch[name] = [o[at] for o in outcomes]
                yield batch

        return rows.mapInPandas(run, schema)

    return step


@dataclass(frozen=True)
class Attempted:
    """The `outcomes` of rows, and the `log` (item_id, attempt, status, error_code, message, translated) that they follow from."""

    outcomes: DataFrame
    log: DataFrame


def attempt_in_rounds(
    rows: DataFrame,
    open_client: Callable[[int], Callable[[str, str, str], str]],
    error_code: Callable[[Exception], str | None] = lambda e: getattr(e, "code", None),
    wait: Callable[[float], None] | None = None,
    attempts: int = V.MAX_TRANSLATION_ATTEMPTS,
    key: str = "row_key",
    ledger: Ledger | None = None,
    at_once: int = AT_ONCE,
) -> Attempted:
    """Translate foreign rows in rounds over a queue; every attempt is a row of the log.

    `open_client(round)` runs once per task and gives `f(text, source, target)`. A row whose attempt was throttled
    goes to the next round's queue, and the job waits 2 s, then 4 s, once for all of them; other rows
    wait for none. Attempts are kept in `ledger` (default: a new one) under the row's `key` and the round, so neither a task
    that is tried again nor a run over the same ledger repeats one (a killed process can lose the `at_once` that it is at). `key` is unique; rows in the source language pass.

    Texts are not written again: `rows` is read for every round (large ones several times), so settle it first where it is dear to make, and
    translations are read from the ledger when `outcomes` or `log` are, if they are asked for.
    """
    import time

    spark = rows.sparkSession
    ledger, pause, source = ledger or Ledger.fresh(spark), wait or time.sleep, V.SOURCE_LANGUAGE
    text = T.StringType()
    answer = T.StructType([T.StructField(c, text) for c in ("status", "error_code", "message", "translated")])

    def asker(round_: int) -> Callable[[], Ask]:
        def open_() -> Ask:
            client = None

            def one(value: str, target: str) -> tuple:
                nonlocal client
                try:
                    client = client or open_client(round_)
                    return "success", None, None, client(value, source, target)
                except Exception as problem:
                    return "failure", error_code(problem), str(problem), None

            return lambda asked: [one(*a) for a in asked]

        return open_

    item = F.col(f"`{key}`").cast("string")
    foreign = rows.filter(_foreign()).select(item.alias("item_id"), "text", "target_language")
    queue = measure(foreign)
    tasks = tasks_for(spark, queue.nbytes)
    ledger = ledger.dealt(queue, tasks)
    log: list[DataFrame] = []
    for attempt in range(attempts):
        asked = Settled(queue.df.withColumn("call", F.concat_ws("#", "item_id", F.lit(attempt))), queue.rows, queue.nbytes)
        answers = settle_calls(asked, "call", ["text", "target_language"], answer, asker(attempt), ledger, answer.names[:3], at_once).df
        tried = answers.withColumn("item_id", F.regexp_extract("call", r"(?s)^(.*)#\d+$", 1)).withColumn("attempt", F.lit(attempt).cast("bigint"))
        log.append(tried)
        throttled = settle(tried.filter(F.col("error_code") == V.THROTTLED).select("item_id"), "throttled")
        if not throttled.rows or attempt == attempts - 1:
            break
        queue = measure(lookup_join(foreign, throttled, ["item_id"], ["item_id"], how="left_semi"))
        pause(V.FIRST_RETRY_WAIT_SECONDS * 2**attempt)
    entries = reduce(DataFrame.unionByName, log)
    calls = entries.filter(F.col("status") == "success").select("item_id", F.col("call").alias("_call"))
    known = retry_outcome(entries, attempts).join(calls, "item_id", "left").select(F.col("item_id").alias("_item"), *OUTCOME[:3], "_call")
    joined = lookup_join(rows.withColumn("_item", item), settle(known, "outcomes"), ["_item"], [key])
    outcomes = with_answers(joined, "_call", "call", answer["translated"], ledger, tasks, key)
    passed = F.when(_foreign(), F.col("status")).otherwise("passed").alias("status")
    return Attempted(
        outcomes.select(*[F.col(f"`{c}`") for c in rows.columns], passed, *OUTCOME[1:]),
        with_answers(entries, "call", "call", answer["translated"], ledger, tasks, "item_id").select("item_id", "attempt", *answer.names),
    )


def translate_in_rounds(open_client: Callable[[int], Callable[[str, str, str], str]], **options) -> Callable[[DataFrame], DataFrame]:
    """A translation step of `attempt_in_rounds`; `options` are those of it."""
    return lambda rows: attempt_in_rounds(rows, open_client, **options).outcomes


def failure_marker(language: Column, status: Column, code: Column) -> Column:
    """Bracketed marker for a row that could not be translated; null otherwise."""
    upper = F.upper(language)
    return (
        F.when(status == "failed", F.concat(F.lit("["), upper, F.lit("_FAILED_"), code, F.lit("] ")))
        .when(status == "error", F.concat(F.lit("["), upper, F.lit("_ERROR] ")))
        .when(status == "no_client", F.concat(F.lit("["), upper, F.lit("_NO_CLIENT] ")))
    )


def mark_failures(translated: DataFrame) -> DataFrame:
    """Final `text`: the translation, the source text, or the marked source text."""
    marker = failure_marker(F.col("target_language"), F.col("status"), F.col("error_code"))
    text = F.coalesce("translated", F.concat(marker, F.col("text")), F.col("text"))
    return translated.withColumn("text", text)


def retry_outcome(attempts: DataFrame, most: int = V.MAX_TRANSLATION_ATTEMPTS) -> DataFrame:
    """Outcome per item from a log of (item_id, attempt, status, error_code, message).

    The first attempt that succeeds, fails for another reason than throttling, or
    is the last allowed decides; attempts after it do not count. An item whose log
    ends before that is pending.
    """
    final = (
        (F.col("status") == "success")
        | (F.col("error_code").isNull() | (F.col("error_code") != V.THROTTLED))
        | (F.col("attempt") >= most - 1)
    )
    entry = F.struct("attempt", "status", "error_code", "message")
    decided = F.min(F.when(final, entry))
    seen = attempts.groupBy("item_id").agg(decided.alias("_final"), F.max(entry).alias("_last"))
    chosen = F.coalesce("_final", "_last")
    done = seen.withColumn("_pick", chosen)
    n_before = F.col("_pick.attempt") + F.when(F.col("_final").isNull(), 1).otherwise(0)
    # 2 s, then 4 s: 2 * (2^k - 1) seconds after k throttled attempts.
    waited = V.FIRST_RETRY_WAIT_SECONDS * (F.pow(F.lit(2), n_before) - 1)
    status = (
        F.when(F.col("_final").isNull(), "pending")
        .when(F.col("_pick.status") == "success", "translated")
        .when(F.col("_pick.error_code").isNotNull(), "failed")
        .otherwise("error")
    )
    return done.select(
        "item_id",
        (F.col("_pick.attempt") + 1).cast("bigint").alias("n_attempts"),
        status.alias("status"),
        F.col("_pick.error_code").alias("error_code"),
        F.col("_pick.message").alias("message"),
        waited.cast("bigint").alias("waited_seconds"),
    )


def translation_stats(outcomes: DataFrame) -> DataFrame:
    """One row: attempted, successful, failed, success rate (null when none succeeded)."""
    good = F.count_if(F.col("status") == "translated")
    bad = F.count_if(F.col("status").isin("failed", "error"))
    tried = good + bad
    return outcomes.agg(
        tried.alias("attempted"),
        good.alias("successful"),
        bad.alias("failed"),
        F.when(good > 0, good / tried * 100).alias("success_rate"),
    )


def error_histogram(outcomes: DataFrame) -> DataFrame:
    """Failures counted by `code: message`; uncoded ones as `UnknownError`."""
    name = F.concat(F.coalesce("error_code", F.lit("UnknownError")), F.lit(": "), F.coalesce("message", F.lit("")))
    bad = outcomes.filter(F.col("status").isin("failed", "error"))
    return bad.groupBy(name.alias("error_type")).agg(F.count(F.lit(1)).alias("n"))
