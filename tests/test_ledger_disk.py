"""A translation's text is stored once, in the ledger, and moved only where it is asked for."""

import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.functions import fixed_values as V
from labelloom.operators import translate as R
from labelloom.plans import joins, ledger as K
from labelloom.plans.ledger import Ledger, record_calls, with_answers
from labelloom.plans.shared import shared_folder, settle

SCHEMA = "row_key string, text string, target_language string"
ANSWER = T.StructType([T.StructField("said", T.StringType()), T.StructField("n", T.LongType())])


class Throttled(Exception):
    code = V.THROTTLED


def echo(round_):
    return lambda text, source, target: f"{target}> {text}"


def moody(round_):
    """Texts that end in 1 are throttled once, those in 2 always, those in 3 fail."""

    def call(text, source, target):
        if text.endswith("1") and round_ < 1 or text.endswith("2"):
            raise Throttled("slow")
        if text.endswith("3"):
            raise RuntimeError("odd")
        return f"{target}> {text}"

    return call


def stored_bytes(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files)


def told(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_texts_are_stored_once(spark):
    """The queue, the attempts and the outcomes are kept without their texts."""
    rows = spark.range(400).selectExpr("cast(id AS string) AS row_key", "id", "if(id % 4 = 0, 'en', 'es') AS target_language")
    rows = rows.withColumn("text", F.concat(*[F.sha2(F.concat("id", F.lit(f"|{i}")), 256) for i in range(60)])).drop("id")
    asked = rows.filter("target_language = 'es'").agg(F.sum(F.length("text"))).first()[0]
    folder = shared_folder(spark)
    before = stored_bytes(folder)
    made = R.attempt_in_rounds(rows, echo, wait=lambda s: None)
    assert made.outcomes.filter("translated = concat('es> ', text)").count() == 300
    assert made.log.filter("length(translated) = 60 * 64 + 4").count() == 300
    assert stored_bytes(folder) - before < asked


@pytest.mark.parametrize("broadcast", [True, False])
def test_shares_of_the_slices_come_to_the_same(spark, tmp_path, monkeypatch, broadcast):
    """Large requests go a share at a time; every call is made once, whatever the share, the round and the kind of join."""
    if not broadcast:
        monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    rows = spark.range(240).selectExpr("cast(id AS string) AS row_key", "concat('t', id % 120) AS text", "if(id < 120, 'es', 'fr') AS target_language")
    plain = R.attempt_in_rounds(rows, moody, wait=lambda s: None)
    asked = []
    monkeypatch.setattr(K, "SHARE_BYTES", 3000)
    whole = K.record_calls

    def counted(*some, **options):
        out = whole(*some, **options)
        asked.append((options["share"], out.count()))
        return out

    def marking(round_):
        def call(text, source, target):
            with open(tmp_path / f"{round_}-{text}-{target}", "a") as f:
                f.write("x")
            return moody(round_)(text, source, target)

        return call

    monkeypatch.setattr(K, "record_calls", counted)
    shared = R.attempt_in_rounds(rows, marking, wait=lambda s: None)
    assert told(shared.outcomes) == told(plain.outcomes) and told(shared.log) == told(plain.log)
    first = [n for (_, shares), n in asked[:4] if shares == 4]
    assert len(first) == 4 and sum(first) == 240 and max(first) < 120
    assert all(os.path.getsize(tmp_path / f) == 1 for f in os.listdir(tmp_path))
    kinds = {r.row_key: (r.status, r.error_code, r.translated) for r in shared.outcomes.collect()}
    assert kinds["1"] == ("translated", None, "es> t1") and kinds["122"] == ("failed", V.THROTTLED, None)
    assert kinds["3"] == ("error", None, None) and len(kinds) == 240


def test_repeated_and_missing_keys(spark):
    """Keys that repeat or are null: rows come as often as a join with the log makes them."""
    rows = spark.createDataFrame(
        [("a", "x", "es"), ("a", "x", "es"), ("b", "x3", "es"), ("b", "x3", "es"), (None, "x", "es"), ("c", "x", None), ("d", "x", "en"), ("a", "x", "en"),
         (None, "x", "en"), ("e", "x1", "fr"), ("e", "x1", "fr"), ("f", "x2", "fr"), ("g", None, "fr")], SCHEMA)
    made = R.attempt_in_rounds(rows, moody, wait=lambda s: None)
    none = "'NoneType' object has no attribute 'endswith'"
    assert told(made.outcomes) == sorted([
        *[("a", "x", "es", "translated", None, None, "es> x")] * 4, *[("a", "x", "en", "passed", None, None, "es> x")] * 2,
        *[("b", "x3", "es", "error", None, "odd", None)] * 2, (None, "x", "es", None, None, None, None), (None, "x", "en", "passed", None, None, None),
        ("c", "x", None, "passed", None, None, None), ("d", "x", "en", "passed", None, None, None), *[("e", "x1", "fr", "translated", None, None, "fr> x1")] * 4,
        ("f", "x2", "fr", "failed", V.THROTTLED, "slow", None), ("g", None, "fr", "error", None, none, None)], key=repr)
    slow = ("failure", V.THROTTLED, "slow", None)
    assert told(made.log) == sorted([
        *[("a", 0, "success", None, None, "es> x")] * 2, *[("b", 0, "failure", None, "odd", None)] * 2, ("", 0, "success", None, None, "es> x"),
        *[("e", 0, *slow), ("e", 1, "success", None, None, "fr> x1")] * 2, *[("f", i, *slow) for i in range(3)], ("g", 0, "failure", None, none, None)], key=repr)


def test_texts_are_moved_only_where_they_are_asked_for(spark, tmp_path, capsys):
    path = str(tmp_path / "rows")
    spark.createDataFrame([("1", "x", "es"), ("2", "y", "en")], SCHEMA).write.parquet(path)
    made = R.attempt_in_rounds(spark.read.parquet(path), echo, wait=lambda s: None)

    def plan(df):
        capsys.readouterr()
        df.explain()
        return capsys.readouterr().out

    assert "text:string" in plan(made.outcomes) and "text:string" not in plan(made.outcomes.select("row_key", "translated"))
    assert "look_up" not in plan(made.outcomes.select("row_key", "status")) and "look_up" not in plan(made.log.select("item_id", "status"))
    # A filter on the answer stays above the step that reads it slice by slice.
    filtered = plan(made.outcomes.filter("translated = 'es> x'"))
    assert filtered.count("look_up(") == plan(made.outcomes).count("look_up(")
    assert told(made.outcomes.filter("translated = 'es> x'").select("row_key", "text")) == [("1", "x")]


def test_fields_that_are_not_kept_stay_in_the_ledger(spark, tmp_path):
    rows = spark.range(700).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").cast("string").alias("text"))
    ledger = Ledger.open(str(tmp_path / "l"), 0, 2)

    def client():
        return lambda asked: [(f"<{text}>" * 10 if int(text) % 5 else None, int(text)) for (text,) in asked]

    def fails():
        raise AssertionError("asked again")

    for open_client in (client, fails):
        got = record_calls(rows, "key", ["text"], ANSWER, open_client, ledger, keep=["n"])
        assert got.columns == ["key", "n"] and {r.key: r.n for r in got.collect()} == {f"k{i}": i for i in range(700)}
    asked = rows.select(F.when(F.col("text") != "7", F.col("key")).alias("wanted"), "text")
    read = with_answers(asked, "wanted", "key", ANSWER["said"], ledger, 2, "text")
    assert {r.text: r.said for r in read.collect()} == {str(i): f"<{i}>" * 10 if i % 5 and i != 7 else None for i in range(700)}
    lost = settle(spark.createDataFrame([(uuid.uuid4().hex,)], "wanted string")).df
    with pytest.raises(Exception, match="KeyError"):
        with_answers(lost, "wanted", "key", ANSWER["said"], ledger, 2, "wanted").collect()
