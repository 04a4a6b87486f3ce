"""Response parsing, request rounds and quotas."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from labelloom.operators import generate as G
from labelloom.operators import responses as L

START, END = "--- JD START ---", "--- JD END ---"


@pytest.mark.parametrize(
    "text,expected",
    [
        (f"pre {END} x {START} A {END} j {START}  {END} {START} B", ["pre", "A"]),
        (f"{START}\n one \n{END}\n{START}two{END}tail{END}", ["one", "two"]),
        (f"{START}open", []),
        ("", []),
        (None, []),
    ],
)
def test_parse_delimited(spark, text, expected):
    df = spark.createDataFrame([(1, text)], "id int, t string")
    assert [r["text"] for r in L.parse_delimited(df, "t").orderBy("pos").collect()] == expected


def test_other_markers_with_regex_characters(spark):
    df = spark.createDataFrame([("(*a+)(*b+)",)], "t string")
    assert [r["text"] for r in L.parse_delimited(df, "t", "(*", "+)").collect()] == ["a", "b"]


def test_request_plan(spark):
    combos = L.combinations(G.category_frame(spark, ["A"]), ["English"])
    plan = [(r["attempt"], r["n_requested"]) for r in L.request_plan(combos, 12, 5).orderBy("attempt").collect()]
    assert plan == [(1, 5), (2, 5), (3, 2)]
    done = spark.createDataFrame([("A", "English", 10, 4)], "category string, language string, made bigint, used bigint")
    plan = [(r["attempt"], r["n_requested"]) for r in L.request_plan(combos, 12, 5, done).collect()]
    assert plan == [(5, 2)]
    spent = spark.createDataFrame([("A", "English", 0, 5)], "category string, language string, made bigint, used bigint")
    assert L.request_plan(combos, 12, 5, spent).isEmpty()


def test_prompt_and_body(spark):
    plan = spark.createDataFrame([('Cook "x"', "French", 1, 3, "r")],
                                 "category string, language string, attempt bigint, n_requested bigint, request_id string")
    row = L.render_requests(plan).first()
    assert row["prompt"].startswith("<s>[INST] You are an expert") and row["prompt"].endswith("\n [/INST]")
    assert 'generate 3 distinct and realistic job descriptions for the role of "Cook "x"" in French.' in row["prompt"]
    assert "{" not in row["prompt"]
    assert json.loads(row["body"]) == {
        "prompt": row["prompt"], "max_gen_len": 1536, "temperature": 0.75, "top_p": 0.9,
    }


def model(per_call, fail_first=0):
    """A model that gives at most `per_call` texts and fails a combination's first calls."""
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")

    def open_client():
        def call(body):
            import json as j
            import os as o

            prompt = j.loads(body)["prompt"]
            who = prompt.split('for the role of "')[1].split(".\n")[0].replace('"', "")
            asked = int(prompt.split("to generate ")[1].split(" ")[0])
            path = o.path.join(folder, who)
            with open(path, "a") as f:
                f.write(f"{asked}\n")
            if len(open(path).readlines()) <= fail_first:
                raise RuntimeError("busy")
            texts = [f"{START} text {END}" for _ in range(min(asked, per_call))]
            return j.dumps({"generation": "".join(texts)})

        return call

    return open_client, lambda: {n: open(os.path.join(folder, n)).read().split() for n in os.listdir(folder)}


def counts(df):
    return {(r["category_label"], r["language"]): r["count"] for r in df.groupBy("category_label", "language").count().collect()}


def test_one_round_when_answers_are_full(spark):
    client, calls = model(per_call=5)
    out = L.generate_from_model(G.category_frame(spark, ["A", "B"]), client, {"English": "en", "French": "fr"}, n=7, k=5)
    assert counts(out) == {(c, x): 7 for c in "AB" for x in ("English", "French")}
    assert all(sorted(c) == ["2", "5"] for c in calls().values()) and len(calls()) == 4


def test_short_answers_take_more_rounds(spark):
    client, calls = model(per_call=2)
    out = L.generate_from_model(G.category_frame(spark, ["A"]), client, {"English": "en"}, n=7, k=5)
    assert counts(out) == {("A", "English"): 7}
    asked = calls()["A in English"]
    assert sorted(asked[:2]) == ["2", "5"] and asked[2:] == ["3", "1"]


def test_attempts_run_out(spark):
    client, calls = model(per_call=1)
    out = L.generate_from_model(G.category_frame(spark, ["A"]), client, {"English": "en"}, n=20, k=10)
    assert counts(out) == {("A", "English"): 5}
    assert len(calls()["A in English"]) == 20 // 10 + 3


def test_failing_calls_count_as_attempts(spark):
    client, calls = model(per_call=5, fail_first=4)
    out = L.generate_from_model(G.category_frame(spark, ["A"]), client, {"English": "en"}, n=5, k=5)
    assert out.isEmpty() and len(calls()["A in English"]) == 4
    client, calls = model(per_call=5, fail_first=3)
    out = L.generate_from_model(G.category_frame(spark, ["A"]), client, {"English": "en"}, n=5, k=5)
    assert counts(out) == {("A", "English"): 5}


def test_union_fills_missing_columns(spark):
    full = spark.createDataFrame([("t", "c", "en", "fr")], "a string, b string, source_language string, target_language string")
    short = spark.createDataFrame([("u", "d")], "a string, b string")
    assert {tuple(r) for r in L.union_raw(full, short).collect()} == {("t", "c", "en", "fr"), ("u", "d", None, None)}


def test_quota_follows_arrival(spark):
    rows = spark.range(1000).select(F.lit("c").alias("category"), F.lit("l").alias("language"), F.col("id").alias("request_id"), F.lit(0).alias("pos"))
    kept = L.quota_cap(rows.repartition(8), L.COMBINATION, ["request_id", "pos"], 30)
    assert sorted(r["request_id"] for r in kept.collect()) == list(range(30))
