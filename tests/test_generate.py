"""Generation rules on hand-made rows."""

import re

import pytest
from pyspark.sql import functions as F

from labelloom.functions import fixed_values as V
from labelloom.functions.text import split_sentences
from labelloom.operators import generate as G
from labelloom.operators import translate as R


def one(spark, column):
    return spark.range(1).select(column.alias("o")).first()["o"]


@pytest.mark.parametrize(
    "text,skill,expected",
    [
        ("Experience with A. Experience with B.", "Go", "Experience with Go and A. Experience with B."),
        ("Fine skills and skills.", "Go", "Fine skills including Go and skills."),
        ("Skills: many.", "Go", "Skills: many."),
        ("Nothing here.", "Go", "Nothing here. Proficiency in Go is beneficial."),
        ("Uses React daily", "R", "Uses React daily"),
        ("Experience with Go needed", "Go", "Experience with Go needed"),
        ("Plain", None, "Plain"),
    ],
)
def test_insert_skill(spark, text, skill, expected):
    assert one(spark, G.insert_skill(F.lit(text), F.lit(skill).cast("string"))) == expected


def test_prefix_forms(spark):
    keys = spark.range(300)
    out = keys.select(
        F.array_join(G.prefix_context(split_sentences(F.lit("First one. Second")), F.lit("Cook"), F.col("id")), ". ").alias("o")
    )
    verbs, companies, levels = ("|".join(map(re.escape, x)) for x in (V.ACTION_VERBS, V.COMPANY_TYPES, V.SENIORITY_HINTS))
    forms = [
        re.compile(rf"Join ({companies})\. ({verbs}) First one\. Second"),
        re.compile(rf"({verbs}) ({levels}) Cook\. First one\. Second"),
        re.compile(rf"({verbs}) First one\. Second"),
    ]
    hits = [[bool(f.fullmatch(r["o"])) for f in forms] for r in out.collect()]
    assert all(sum(h) == 1 for h in hits)
    assert all(sum(h[i] for h in hits) > 60 for i in range(3))


@pytest.mark.parametrize("text", ["only", "a. b", "a. b. c"])
def test_short_texts_are_not_reordered(spark, text):
    sentences = split_sentences(F.lit(text))
    for key in range(5):
        assert one(spark, G.shuffle_middle(sentences, F.lit(key))) == text.split(". ")


def test_shuffle_keeps_the_ends_and_all_sentences(spark):
    sentences = split_sentences(F.lit("a. b. c. d. e. f"))
    orders = {tuple(r["o"]) for r in spark.range(200).select(G.shuffle_middle(sentences, F.col("id")).alias("o")).collect()}
    assert all(o[0] == "a" and o[-1] == "f" and sorted(o) == list("abcdef") for o in orders)
    assert len(orders) == 24


def test_unique_suffix(spark):
    text = one(spark, G.unique_suffix(F.lit("\n body \t"), F.lit("k")))
    number = re.fullmatch(r"body \(Job ID: (\d{5})\)", text).group(1)
    assert 10000 <= int(number) <= 99999


@pytest.fixture
def library(spark):
    rows = [("Cook", i, f"Template {i}. Makes food. Skills: knives. Cleans. Serves") for i in range(3)]
    rows += [("Pilot", 0, "Flies planes. Experience with weather. Talks")]
    return spark.createDataFrame(rows, "category string, template_idx bigint, template string")


def test_plan_guarantees_enough_texts(spark, library):
    plan = {
        r["category"]: (r["n_templates"], r["variations"])
        for r in G.variation_plan(library, G.category_frame(spark, ["Cook", "Pilot", "Clerk"]), 30).collect()
    }
    assert plan == {"Cook": (3, 11), "Pilot": (1, 31), "Clerk": (0, 30)}


def test_inserted_skill_is_lost_when_a_later_step_fires(spark, library):
    expanded = G.expand(library, G.variation_plan(library, G.category_frame(spark, ["Pilot"]), 300))
    expanded = expanded.withColumn("k", F.col("variation").cast("string"))
    rows = [r["text"] for r in G.vary(expanded, G.skill_frame(spark, {"Pilot": ["Maps"]}), "k").collect()]
    prefixed = [t for t in rows if not t.startswith("Flies planes")]
    plain = [t for t in rows if t.startswith("Flies planes")]
    assert len(rows) == 301
    assert 80 < len(prefixed) < 160 and not any("Maps" in t for t in prefixed)
    with_skill = [t for t in plain if "Experience with Maps and weather" in t]
    # Of the unprefixed texts, the shuffled 30 % lost the skill and 60 % of the rest have it.
    assert 0.3 < len(with_skill) / len(plain) < 0.55


def test_parallel_corpus_and_markers(spark, library):
    categories = G.category_frame(spark, ["Cook", "Pilot", "Clerk"])
    out = G.generate_raw(library, categories, ["en", "es", "zh-TW"], 20, skills={}).collect()
    assert len(out) == 3 * 3 * 20
    english = {r["job_description_text"] for r in out if r["target_language"] == "en"}
    spanish = {r["job_description_text"].removeprefix("[ES_NO_CLIENT] ") for r in out if r["target_language"] == "es"}
    chinese = {r["job_description_text"].removeprefix("[ZH-TW_NO_CLIENT] ") for r in out if r["target_language"] == "zh-TW"}
    assert english == spanish == chinese and len(english) == 60
    generic = [r["job_description_text"] for r in out if r["category_label"] == "Clerk" and r["target_language"] == "en"]
    pattern = r"Standard job description for a Clerk\. .* is required\. \(Ref: GenericJD\d+-\d{4}\)"
    assert len(generic) == 20 and all(re.fullmatch(pattern, g) for g in generic)


def test_default_volume(spark):
    templates = spark.createDataFrame(
        [(c, i, f"{c} {i}. More. Rest") for c in V.CATEGORIES for i in range(5)],
        "category string, template_idx bigint, template string",
    )
    out = G.generate_raw(templates, G.category_frame(spark, V.CATEGORIES))
    counts = {(r["category_label"], r["target_language"]): r["count"]
              for r in out.groupBy("category_label", "target_language").count().collect()}
    assert len(counts) == 36 and set(counts.values()) == {30}


# --- translation ---


class Coded(Exception):
    def __init__(self, code, text):
        super().__init__(text)
        self.code = code


def test_retries_only_throttling(spark):
    def open_client():
        seen = {}

        def call(text, source, target):
            seen[text] = seen.get(text, 0) + 1
            if text == "slow" and seen[text] < 3:
                raise Coded("ThrottlingException", "wait")
            if text == "always":
                raise Coded("ThrottlingException", f"tried {seen[text]}")
            if text == "pair":
                raise Coded("UnsupportedLanguagePairException", f"tried {seen[text]}")
            if text == "boom":
                raise ValueError("broken")
            return f"{target}:{text}:{seen[text]}"

        return call

    rows = spark.createDataFrame(
        [(t, "es") for t in ("ok", "slow", "always", "pair", "boom")] + [("same", "en")],
        "text string, target_language string",
    ).coalesce(1)
    done = R.translate_with(open_client, wait=lambda s: None)(rows)
    out = {r["text"]: tuple(r)[2:] for r in done.collect()}
    assert out == {
        "ok": ("translated", None, None, "es:ok:1"),
        "slow": ("translated", None, None, "es:slow:3"),
        "always": ("failed", "ThrottlingException", "tried 3", None),
        "pair": ("failed", "UnsupportedLanguagePairException", "tried 1", None),
        "boom": ("error", None, "broken", None),
        "same": ("passed", None, None, None),
    }
    final = {r["text"] for r in R.mark_failures(done).collect()}
    assert final == {
        "es:ok:1", "es:slow:3", "[ES_FAILED_ThrottlingException] always",
        "[ES_FAILED_UnsupportedLanguagePairException] pair", "[ES_ERROR] boom", "same",
    }


def test_waits_are_two_and_four_seconds(spark):
    def open_client():
        def call(text, source, target):
            raise Coded("ThrottlingException", "no")

        return call

    def wait(seconds):
        import os

        with open(f"{folder}/{seconds}", "a") as f:
            f.write(f"{os.getpid()}\n")

    import os
    import tempfile

    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    rows = spark.createDataFrame([("x", "es")], "text string, target_language string")
    R.translate_with(open_client, wait=wait)(rows).collect()
    assert sorted(os.listdir(folder)) == ["2", "4"]


def test_retry_outcome_and_statistics(spark):
    throttle = ("failure", "ThrottlingException", "slow")
    log = [
        (1, 0, "success", None, None),
        (2, 0, *throttle), (2, 1, "success", None, None), (2, 2, *throttle),
        (3, 0, *throttle), (3, 1, *throttle), (3, 2, *throttle),
        (4, 0, "failure", "Other", "bad"), (4, 1, "success", None, None),
        (5, 0, *throttle), (5, 1, "failure", None, "crash"),
        (6, 0, *throttle),
    ]
    attempts = spark.createDataFrame(
        log, "item_id bigint, attempt bigint, status string, error_code string, message string"
    )
    outcome = R.retry_outcome(attempts)
    rows = {r["item_id"]: (r["n_attempts"], r["status"], r["error_code"], r["waited_seconds"]) for r in outcome.collect()}
    assert rows == {
        1: (1, "translated", None, 0),
        2: (2, "translated", None, 2),
        3: (3, "failed", "ThrottlingException", 6),
        4: (1, "failed", "Other", 0),
        5: (2, "error", None, 2),
        6: (1, "pending", "ThrottlingException", 2),
    }
    assert tuple(R.translation_stats(outcome).first()) == (5, 2, 3, 40.0)
    assert {tuple(r) for r in R.error_histogram(outcome).collect()} == {
        ("ThrottlingException: slow", 1), ("Other: bad", 1), ("UnknownError: crash", 1),
    }
    none = R.translation_stats(outcome.filter("status <> 'translated'")).first()
    assert none["success_rate"] is None
