"""Quality rules as weak supervision: votes, estimated accuracies, posterior.

Only DataFrame functions are used. Each rule votes good, votes bad or abstains. The
hidden class of a document (good or bad) and the accuracy of every rule on either
class are estimated by expectation-maximisation over the table of vote patterns, which
has at most 3 ** rules rows whatever the number of documents. A document is kept if
the posterior probability of good is at least one half and no base limit is broken.

A rule may miss most bad documents, but it is held to be better than chance: its two
accuracies sum to more than one, so no vote counts for the opposite side. The share of good
documents is held at one half or more, so a document for which all rules vote good is kept.

Null texts have no words; they and empty texts fail the length limit and are not kept. Repeated rows vote once each, and
equal texts get equal verdicts; columns besides key and text are not read, so their names cannot clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.llm.common import WORD_PATTERN, stored

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
ROUNDS = 25
LOW, HIGH, EDGE = 0.55, 0.99, 0.01
# Accuracy on good and on bad documents: a rule rarely errs on good ones, and knows one kind of bad ones.
START = (0.9, 0.3)


def text_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One narrow row per document with the counts that the rules use.

    Words in repeated three-word windows: window hashes are packed with their places
    into one number each and sorted, which brings equal windows together; the few that have a
    neighbour are then compared by full hash. Documents without a repeated window skip this.
    """
    base = docs.select(
        F.col(f"`{key}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"),
    )
    words = base.select("*", F.regexp_extract_all("_text", F.lit(WORD_PATTERN), 0).alias("_words"))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(WORD_PATTERN))
    hashed = words.select(
        "doc_id",
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        F.regexp_count("_text", F.lit(r"!!|\?\?")).cast("bigint").alias("n_shouts"),
        F.regexp_count("_text", F.lit(r"[.!?](?=[\x20\x09-\x0D])|[.!?]\z")).cast("bigint").alias("n_ends"),
        F.regexp_count("_text", F.lit(r"[A-Z\xC0-\xD6\xD8-\xDE]{3,}")).cast("bigint").alias("n_capitals"),
        F.regexp_count("_text", F.lit(r"([!-\-/:-@\[-`{-~])\1+")).cast("bigint").alias("n_sign_runs"),
        F.regexp_count("_text", F.lit(r"[\x20\x09-\x0D][!-/:-@\[-`{-~]+(?=[\x20\x09-\x0D]|\z)")).cast("bigint").alias("n_bare_signs"),
        lines.alias("_lines"),
        F.size(F.array_distinct("_words")).cast("bigint").alias("n_distinct"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"),
    )
    windows = hashed.select(
        *[c for c in hashed.columns if not c.startswith("_")],
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.transform(
            F.slice("_h", F.lit(1), F.greatest(F.size("_h") - 2, F.lit(0))),
            lambda x, i: F.xxhash64(x, F.get("_h", i + 1), F.get("_h", i + 2)),
        ).alias("_w"),
    )
    shift = F.ceil(F.log2(F.size("_w") + 1.0)).cast("int")
    repeats = F.size(F.array_distinct("_w")) < F.size("_w")
    none = F.array().cast("array<bigint>")
    sized = windows.select("*", shift.alias("_s"))
    packed = sized.select(
        "*",
        F.sort_array(F.when(repeats, F.transform("_w", lambda x, i: F.call_function("shiftleft", x, F.col("_s")).bitwiseOR(i.cast("bigint")))).otherwise(none)).alias("_p"),
    )

    def high(x: Column) -> Column:
        return F.call_function("shiftright", x, F.col("_s"))

    def met(x: Column, i: Column) -> Column:
        before, after = high(F.get("_p", i - 1)), high(F.get("_p", i + 1))
        return F.coalesce(high(x) == before, F.lit(False)) | F.coalesce(high(x) == after, F.lit(False))

    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_s")) - 1
    near = packed.select(
        *[c for c in packed.columns if c not in ("_p", "_s")],
        F.transform(F.filter("_p", met), lambda x: x.bitwiseAND(mask).cast("int")).alias("_near"),
    )
    full = near.select(
        *[c for c in near.columns if c not in ("_near", "_w")],
        F.sort_array(F.transform("_near", lambda at: F.struct(F.get("_w", at).alias("w"), at.alias("at")))).alias("_full"),
    )

    def twin(x: Column, i: Column) -> Column:
        before, after = F.get("_full", i - 1)["w"], F.get("_full", i + 1)["w"]
        return F.coalesce(x["w"] == before, F.lit(False)) | F.coalesce(x["w"] == after, F.lit(False))

    covered = F.flatten(F.transform(F.filter("_full", twin), lambda x: F.array(x["at"], x["at"] + 1, x["at"] + 2)))
    return full.select(
        *[c for c in full.columns if c != "_full"],
        F.size(F.array_distinct(covered)).cast("bigint").alias("n_repeat_words"),
    )


def _vote(good: Column, bad: Column) -> Column:
    """1 good, 0 bad, null abstains."""
    return F.when(bad, F.lit(0)).when(good, F.lit(1))


def votes() -> dict[str, Column]:
    """The rules, over the columns of `text_statistics`."""
    n, chars, lines = F.col("n_words"), F.col("word_chars"), F.col("n_lines")
    return {
        "length": _vote(n >= 100, n < 50),
        "word_length": _vote((chars >= 3 * n) & (chars <= 10 * n), (2 * chars < 5 * n) | (chars > 12 * n) | (n == 0)),
        "symbols": _vote(100 * F.col("n_symbols") <= 3 * n, 100 * F.col("n_symbols") > 10 * n),
        "symbol_chars": _vote(100 * F.col("n_symbols") <= chars, 100 * F.col("n_symbols") > 3 * chars),
        "sign_runs": _vote(100 * F.col("n_sign_runs") <= n, 100 * F.col("n_sign_runs") > 5 * n),
        "bare_signs": _vote(100 * F.col("n_bare_signs") <= 2 * n, 100 * F.col("n_bare_signs") > 5 * n),
        "dup_lines": _vote(10 * F.col("n_dup_lines") <= lines, 10 * F.col("n_dup_lines") > 3 * lines),
        "repeats": _vote(10 * F.col("n_repeat_words") <= n, 10 * F.col("n_repeat_words") > 3 * n),
        "shouts": _vote(100 * F.col("n_shouts") <= n, 100 * F.col("n_shouts") > 5 * n),
        "capitals": _vote(100 * F.col("n_capitals") <= 5 * n, 100 * F.col("n_capitals") > 20 * n),
        "variety": _vote(10 * F.col("n_distinct") >= 3 * n, 20 * F.col("n_distinct") < 3 * n),
        "sentences": _vote(50 * F.col("n_ends") >= n, 200 * F.col("n_ends") < n),
    }


def estimate(patterns: DataFrame, rules: list[str], rounds: int = ROUNDS) -> tuple[float, dict[str, tuple[float, float]]]:
    """(share of good documents, {rule: (accuracy on good, accuracy on bad)}).

    `patterns` has a column per rule and `n`, the documents with that pattern. A
    round is one aggregate of 2 + 4 * rules sums, read back as a single row.
    """
    share, accuracy = 0.5, dict.fromkeys(rules, START)
    for _ in range(rounds):
        p = posterior(share, accuracy)
        sums = [F.sum(F.col("n") * p).alias("good"), F.sum(F.col("n")).cast("double").alias("all")]
        for r in rules:
            voted = F.col("n") * F.col(r).isNotNull().cast("double")
            sums += [
                F.sum(voted * p).alias(f"{r}_good"),
                F.sum(voted * p * F.coalesce(r, F.lit(0))).alias(f"{r}_good_right"),
                F.sum(voted * (1 - p)).alias(f"{r}_bad"),
                F.sum(voted * (1 - p) * (1 - F.coalesce(r, F.lit(0)))).alias(f"{r}_bad_right"),
            ]
        row = patterns.agg(*sums).first()
        if not row["all"]:
            break
        then = share
        share = min(0.95, max(0.5, row["good"] / row["all"]))
        before = accuracy
        # Two imagined votes of the starting accuracy keep rarely used rules in place.
        accuracy = {}
        for r in rules:
            on_good, on_bad = ((row[f"{r}_{side}_right"] + 2 * first) / (row[f"{r}_{side}"] + 2) for side, first in zip(("good", "bad"), START))
            on_good = min(HIGH, max(LOW, on_good))
            accuracy[r] = (on_good, min(HIGH, max(1 - on_good + EDGE, on_bad)))
        moved = max([abs(share - then), *(abs(a - b) for r in rules for a, b in zip(accuracy[r], before[r]))])
        if moved < 1e-6:
            break
    return share, accuracy


def posterior(share: float, accuracy: dict[str, tuple[float, float]]) -> Column:
    """Probability of good, from a column per rule."""
    odds = F.lit(math.log(share / (1 - share)))
    for rule, (on_good, on_bad) in accuracy.items():
        for_good, for_bad = math.log(on_good / (1 - on_bad)), math.log((1 - on_good) / on_bad)
        odds = odds + F.when(F.col(rule) == 1, for_good).when(F.col(rule) == 0, for_bad).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Counts, `base_failed`, `score` (posterior) and `kept`, a row per document."""
    rules = votes()
    voted = stored(text_statistics(docs, key, text).withColumns(rules), "quality-votes")
    patterns = stored(voted.groupBy(*rules).agg(F.count(F.lit(1)).alias("n")), "quality-patterns")
    share, accuracy = estimate(patterns, list(rules), rounds)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return voted.withColumns({"base_failed": failed, "score": posterior(share, accuracy)}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= 0.5)
    )
