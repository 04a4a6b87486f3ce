"""URL filter: host and path rules first, then words segmented from names and naive Bayes.

Names in hosts run words together. A run of letters is split by Viterbi under a unigram
model: of all ways to cut it, the one with the highest product of word frequencies. The
frequencies are counted over all page texts; only words that are part of some run are
looked up, so no dictionary is shipped to tasks. Unknown stretches cost more the longer
they are. Multinomial naive Bayes over segmented host words and path words is learned from the
urls that the rules decide, and decides the others.

Null urls and urls without "://" have empty host and path and no words; the prior
alone decides them, and with nothing to learn from the verdict is allow. Repeated
rows are judged alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.llm.common import stored
from labelloom.plans.joins import lookup_join

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_WORD = 24
RUNS = r"\p{L}+|[0-9]+"
NUMBER = "#"

# Fixed values: (verdict, host, path).
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (ASCII lower case) and path; empty where there is no "://"."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.translate(F.regexp_extract(F.coalesce(rest, F.lit("")), r"\A([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(F.coalesce(rest, F.lit("")), r"\A[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest fitting rule as text, and its verdict; null when none fits."""
    rule = verdict = F.lit(None).cast("string")
    for says, on, below in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == on) | host.endswith("." + on)) & path.startswith(below)
        rule, verdict = F.when(fits, F.lit(on + below)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def word_counts(pages: DataFrame, html: str = "html") -> DataFrame:
    """(word, n) over all page texts, markup left out."""
    plain = F.lower(F.regexp_replace(F.col(f"`{html}`"), r"(?s)<[^>]*>", " "))
    return pages.select(F.explode(F.regexp_extract_all(plain, F.lit(r"\p{L}+"), 0)).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")
    )


def best_cut(run: str, known: dict[tuple[int, int], float], log_total: float) -> list[str]:
    """The most probable words of `run`; `known` has log counts of stretches (start, length)."""
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(run) + 1):
        options = []
        for start in range(max(0, end - MAX_WORD), end):
            size = end - start
            log_n = known.get((start, size))
            # An unknown stretch counts as a tenth of a word for every letter.
            cost = log_n - log_total if log_n is not None else -log_total - size * math.log(10)
            options.append((best[start][0] + cost, -start))
        score, start = max(options)
        best.append((score, -start))
    words, end = [], len(run)
    while end:
        start = best[end][1]
        words.append(run[start:end])
        end = start
    return words[::-1]


def segment_runs(runs: DataFrame, counts: DataFrame) -> DataFrame:
    """(run, words) for distinct `runs(run)`."""
    places = F.explode(F.sequence(F.lit(1), F.length("run"))).alias("start")
    spans = runs.select("run", places).select(
        "run", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(MAX_WORD), F.length("run") - F.col("start") + 1))).alias("size")
    )
    pieces = spans.withColumn("word", F.expr("substring(run, start, size)"))
    total = counts.agg(F.sum("n")).first()[0] or 1
    wanted = pieces.select("word").distinct()
    known = stored(counts.join(wanted, "word", "left_semi"), "url-words")
    found = lookup_join(pieces, known, ["word"], ["run", "start"], how="inner")
    listed = found.groupBy("run").agg(F.collect_list(F.struct("start", "size", "n")).alias("found"))
    with_all = runs.join(listed, "run", "left")
    log_total = math.log(total)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            words = []
            for run, found in zip(frame["run"], frame["found"]):
                known = {(f["start"] - 1, f["size"]): math.log(f["n"]) for f in (found if found is not None else ())}
                words.append(best_cut(run, known, log_total))
            yield pd.DataFrame({"run": frame["run"], "words": words})

    return stored(with_all.mapInPandas(work, "run string, words array<string>"), "url-segments")


def _marked(words: Column, mark: str) -> Column:
    return F.transform(words, lambda w: F.concat(F.lit(mark), F.when(w.rlike("^[0-9]+$"), NUMBER).otherwise(w)))


def url_tokens(urls: DataFrame, counts: DataFrame) -> DataFrame:
    """`urls(host, path, ...)` with `tokens`: segmented host words and path words."""
    hosts = stored(urls.select("host").distinct(), "url-hosts")
    parts = hosts.select("host", F.explode(F.regexp_extract_all("host", F.lit(RUNS), 0)).alias("run"))
    letters = stored(parts.filter(~F.col("run").rlike("^[0-9]")).select("run").distinct(), "url-runs")
    segments = segment_runs(letters, counts)
    cut = lookup_join(parts, segments, ["run"], ["host"]).withColumn("words", F.coalesce("words", F.array("run")))
    named = stored(cut.groupBy("host").agg(F.flatten(F.collect_list("words")).alias("words")), "url-host-words")
    joined = lookup_join(urls, named, ["host"], ["host", "path"])
    path_words = F.regexp_extract_all(F.translate("path", UPPER, LOWER), F.lit(RUNS), 0)
    none = F.array().cast("array<string>")
    return joined.withColumn(
        "tokens", F.concat(_marked(F.coalesce("words", none), "h:"), _marked(path_words, "p:"))
    ).drop("words")


def learn_bayes(tokens: DataFrame) -> tuple[DataFrame, float]:
    """(token, odds) towards block with add-one smoothing, and the prior odds, from rows that a rule decides.

    `tokens` has verdict (null where no rule fits), n (pages) and tokens.
    """
    told = tokens.filter("verdict IS NOT NULL")
    classes = {r["verdict"]: int(r["n"]) for r in told.groupBy("verdict").agg(F.sum("n").alias("n")).collect()}
    weight = {v: F.sum(F.when(F.col("verdict") == v, F.col("n")).otherwise(0)).alias(v) for v in ("allow", "block")}
    counts = stored(told.select("verdict", "n", F.explode("tokens").alias("token")).groupBy("token").agg(*weight.values()), "url-tokens")
    sums = counts.agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"), F.count(F.lit(1)).alias("kinds")).first()
    allow, block, kinds = (float(sums[c] or 0) for c in ("allow", "block", "kinds"))
    prior = math.log((classes.get("block", 0) + 1) / (classes.get("allow", 0) + 1))
    odds = F.log((F.col("block") + 1) / F.lit(block + kinds + 1)) - F.log((F.col("allow") + 1) / F.lit(allow + kinds + 1))
    return counts.select("token", odds.alias("odds")), prior


def judge_urls(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, odds): a row per row of `pages`; odds above 0 speak for block."""
    host, path = url_parts(F.col(f"`{url}`"))
    parsed = pages.select(F.col(f"`{key}`").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    urls = stored(parsed.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")).withColumns({"rule": rule, "verdict": verdict}), "urls")
    tokens = stored(url_tokens(urls, word_counts(pages, html)), "url-token-lists")
    odds, prior = learn_bayes(tokens)
    parts = tokens.select("host", "path", F.explode_outer("tokens").alias("token"))
    scored = lookup_join(parts, odds, ["token"], ["host", "path"]).groupBy("host", "path").agg(
        (F.coalesce(F.sum("odds"), F.lit(0.0)) + F.lit(prior)).alias("odds")
    )
    judged = urls.join(scored, ["host", "path"]).select(
        "host", "path", "rule", F.coalesce("verdict", F.when(F.col("odds") > 0, "block").otherwise("allow")).alias("verdict"), "odds"
    )
    return lookup_join(parsed, stored(judged, "url-verdicts"), ["host", "path"], ["page_id"])
