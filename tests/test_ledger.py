"""Calls are made once: retried tasks, repeated runs, attempts side by side."""

import os
import threading
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.functions import fixed_values as V
from labelloom.operators import responses as L
from labelloom.operators import translate as R
from labelloom.plans import ledger as K
from labelloom.plans.ledger import Ledger, Slice, record_calls

ANSWER = T.StructType([T.StructField("said", T.StringType()), T.StructField("n", T.LongType())])


def counting(folder, die_at=None):
    """A client that leaves a mark for every call, and kills its process once at a chosen row."""

    def open_client():
        def ask(rows):
            out = []
            for (text,) in rows:
                if text == die_at:
                    try:
                        os.mkdir(f"{folder}/died")
                    except FileExistsError:
                        pass
                    else:
                        os._exit(1)
                with open(f"{folder}/calls-{text}", "a") as f:
                    f.write("x")
                out.append((f"<{text}>" if int(text) % 5 else None, int(text)))
            return out

        return ask

    return open_client


def calls(folder):
    return {f.removeprefix("calls-"): os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder) if f.startswith("calls-")}


def requests(spark, n):
    return spark.range(n).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").cast("string").alias("text"))


def said(df):
    return {r.key: (r.said, r.n) for r in df.collect()}


@pytest.fixture
def retrying():
    """Local mode with tasks that may fail."""
    import subprocess
    import sys

    def run(code, folder):
        env = os.environ | {"PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
        return subprocess.run([sys.executable, "-c", code, folder], env=env, capture_output=True, text=True, timeout=300)

    return run


DYING = """
import sys
from labelloom.session import build_session
from labelloom.plans.ledger import Ledger, record_calls
from tests.test_ledger import ANSWER, counting, requests, said
spark = build_session("dying", "local[3,4]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "3", "spark.checkpoint.dir": sys.argv[1] + "/shared"})
ledger = Ledger.open(sys.argv[1] + "/ledger", 200)
df = record_calls(requests(spark, 200), "key", ["text"], ANSWER, counting(sys.argv[1], "150"), ledger, at_once=1, tasks=3)
assert said(df) == {f"k{i}": (f"<{i}>" if i % 5 else None, i) for i in range(200)}
print("whole")
"""


def test_a_task_that_dies_half_way_repeats_no_call(retrying, tmp_path):
    done = retrying(DYING, str(tmp_path))
    assert "whole" in done.stdout, done.stderr[-2000:]
    assert os.path.isdir(tmp_path / "died")
    assert calls(tmp_path) == {str(i): 1 for i in range(200)}


def test_a_repeated_run_asks_for_what_is_missing_only(spark, tmp_path):
    ledger = Ledger.open(str(tmp_path / "ledger"), 50, 4)
    first = record_calls(requests(spark, 50), "key", ["text"], ANSWER, counting(str(tmp_path)), ledger)
    assert len(said(first)) == 50
    again = record_calls(requests(spark, 80), "key", ["text"], ANSWER, counting(str(tmp_path)), Ledger.open(str(tmp_path / "ledger")))
    assert said(again) == said(again) and len(said(again)) == 80
    assert calls(tmp_path) == {str(i): 1 for i in range(80)}
    schema = T.StructType([T.StructField("key", T.StringType()), *ANSWER.fields])
    assert said(ledger.answers(spark, schema)) == said(again)


def test_rows_of_one_key_share_a_call(spark, tmp_path):
    rows = requests(spark, 10).union(requests(spark, 10)).union(requests(spark, 10))
    got = record_calls(rows, "key", ["text"], ANSWER, counting(str(tmp_path)), Ledger.open(str(tmp_path / "l")), at_once=3)
    assert got.count() == 30
    assert calls(tmp_path) == {str(i): 1 for i in range(10)}


def test_no_rows_no_client(spark, tmp_path):
    def fails():
        raise AssertionError("opened")

    assert record_calls(requests(spark, 0), "key", ["text"], ANSWER, fails, Ledger.open(str(tmp_path / "l"))).count() == 0


def _slice(ledger, task, attempt, lease=30.0, side_by_side=True):
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(T.StructType([T.StructField("key", T.StringType()), *ANSWER.fields]))
    out = Slice(ledger, 0, schema, lease, side_by_side)
    out.task, out.attempt = task, attempt
    out.claim = f"{out.claims}/{task}~{attempt}~{attempt}"
    return out


def test_attempts_side_by_side_ask_once(tmp_path, monkeypatch):
    """The second attempt waits for the first one's answers instead of calling."""
    monkeypatch.setattr(K, "POLL_SECONDS", 0.01)
    ledger = Ledger.open(str(tmp_path / "l"))
    one, two = _slice(ledger, "5-0", 0), _slice(ledger, "5-0", 1)
    assert one.take({"a", "b"})
    took = []
    waiting = threading.Thread(target=lambda: took.append(two.take({"a", "b"})))
    waiting.start()
    time.sleep(0.2)
    one.write([("a", "x", 1)])
    time.sleep(0.1)
    assert waiting.is_alive()
    one.write([("b", "y", 2)])
    one.leave()
    waiting.join(10)
    assert took == [False] and two.known == {"a": ("x", 1), "b": ("y", 2)}


def test_a_dead_claim_is_taken_over(tmp_path, monkeypatch):
    monkeypatch.setattr(K, "POLL_SECONDS", 0.01)
    ledger = Ledger.open(str(tmp_path / "l"))
    assert _slice(ledger, "5-0", 0).take({"a"})
    start = time.time()
    # The task's own earlier attempt is dead when Spark runs one at a time.
    later = _slice(ledger, "5-0", 1, side_by_side=False)
    assert later.take({"a"}) and time.time() - start < 1
    later.leave()
    # Anyone else waits until nothing was written for the lease.
    assert _slice(ledger, "9-3", 0, lease=0.5).take({"a"}) and time.time() - start >= 0.4


def test_model_calls_are_kept(spark, tmp_path):
    combos = spark.createDataFrame([("a",), ("b",)], "category string")
    plan = L.render_requests(L.request_plan(L.combinations(combos, ["English"]), 10, 5))

    def open_client():
        def call(body):
            with open(f"{tmp_path}/n", "a") as f:
                f.write("x")
            if '"max_gen_len":2560' not in body:
                raise RuntimeError("odd")
            return "{}"

        return call

    ledger = Ledger.open(str(tmp_path / "l"))
    for _ in range(2):
        got = L.call_model(plan, open_client, ledger=ledger)
        assert {r.request_id: (r.response, r.error) for r in got.collect()} == {r.request_id: ("{}", None) for r in plan.collect()}
        assert got.columns == ["category", "language", "attempt", "n_requested", "request_id", "response", "error"]
    assert os.path.getsize(tmp_path / "n") == plan.count()


class Coded(Exception):
    def __init__(self, code):
        super().__init__(f"because {code}")
        self.code = code


def test_rounds_wait_once_and_go_on_with_the_others(spark, tmp_path):
    rows = spark.createDataFrame(
        [("1", "fine", "es"), ("2", "slow", "es"), ("3", "never", "fr"), ("4", "bad", "fr"), ("5", "odd", "fr"), ("6", "kept", "en"), ("#7#1", "slow", "fr")],
        "row_key string, text string, target_language string",
    )

    def open_client(round_):
        def call(text, source, target):
            with open(f"{tmp_path}/{round_}-{text}-{target}", "a") as f:
                f.write("x")
            if text == "never" or text == "slow" and round_ < 1:
                raise Coded(V.THROTTLED)
            if text == "bad":
                raise Coded("Unsupported")
            if text == "odd":
                raise RuntimeError("odd")
            return f"{source}>{target}:{text}"

        return call

    waits = []
    made = R.attempt_in_rounds(rows, open_client, wait=waits.append)
    got = {r.row_key: (r.status, r.error_code, r.message, r.translated) for r in made.outcomes.collect()}
    assert got == {
        "1": ("translated", None, None, "en>es:fine"),
        "2": ("translated", None, None, "en>es:slow"),
        "#7#1": ("translated", None, None, "en>fr:slow"),
        "3": ("failed", V.THROTTLED, f"because {V.THROTTLED}", None),
        "4": ("failed", "Unsupported", "because Unsupported", None),
        "5": ("error", None, "odd", None),
        "6": ("passed", None, None, None),
    }
    assert waits == [2, 4]
    log = {(r.item_id, r.attempt): r.status for r in made.log.collect()}
    assert sorted(a for i, a in log if i == "3") == [0, 1, 2] and log["2", 1] == "success" and ("4", 1) not in log
    assert all(os.path.getsize(tmp_path / f) == 1 for f in os.listdir(tmp_path))
    # The same outcome as the step that waits within its tasks.
    slow = {}

    def open_old():
        def call(text, source, target):
            slow[text, target] = slow.get((text, target), -1) + 1
            return open_client(slow[text, target])(text, source, target)

        return call

    old = R.translate_with(open_old, wait=lambda s: None)(rows.coalesce(1))
    assert {r.row_key: (r.status, r.error_code, r.message, r.translated) for r in old.collect()} == got


def test_nothing_foreign_and_no_rows(spark):
    def fails(round_):
        raise AssertionError("opened")

    schema = "row_key string, text string, target_language string"
    for rows in ([], [("1", "x", "en")]):
        made = R.attempt_in_rounds(spark.createDataFrame(rows, schema), fails, wait=fails)
        assert made.outcomes.count() == len(rows) and made.log.count() == 0


def test_slices_and_tasks_follow_the_requests(spark, tmp_path, monkeypatch):
    """A ledger opened without a number of requests is dealt by its first run, by their number or their bytes."""
    monkeypatch.setattr(K, "SLICE_ROWS", 10)
    monkeypatch.setattr(K, "TASK_BYTES", 600)
    df = record_calls(requests(spark, 200), "key", ["text"], ANSWER, counting(str(tmp_path)), Ledger.open(str(tmp_path / "l")))
    assert len(said(df)) == 200 and df.rdd.getNumPartitions() >= 12
    assert Ledger.open(str(tmp_path / "l")).slices >= 20
    monkeypatch.setattr(K, "SLICE_BYTES", 50)
    wide = requests(spark, 50).withColumn("text", F.concat(F.lpad("text", 20, "0")))
    record_calls(wide, "key", ["text"], ANSWER, counting(str(tmp_path)), Ledger.open(str(tmp_path / "w"))).count()
    assert Ledger.open(str(tmp_path / "w")).slices >= 40


def test_rounds_deal_their_ledger_by_the_queue(spark, monkeypatch):
    monkeypatch.setattr(K, "SLICE_ROWS", 5)
    rows = spark.range(200).selectExpr("cast(id AS string) AS row_key", "concat('text ', id) AS text", "'es' AS target_language")
    ledger = Ledger.fresh(spark)
    made = R.attempt_in_rounds(rows, lambda round_: lambda text, source, target: text, ledger=ledger)
    assert made.outcomes.filter("translated = text").count() == 200
    assert Ledger.open(ledger.path).slices >= 40
