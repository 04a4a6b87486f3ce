"""Rows without keys, first rows in any order, whole batches, blocked matrices, bad configuration."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from labelloom.functions.hashing import digest
from labelloom.operators import evaluate as E
from labelloom.operators import metrics as M
from labelloom.operators import prepare as P
from labelloom.operators import responses as L
from labelloom.operators import score as Q
from labelloom.operators import split as S
from labelloom.plans.ledger import Ledger
from labelloom.plans.ordering import content_digest, first_in_order, rank_parts


def raw(spark, rows):
    return spark.createDataFrame(rows, "job_description_text string, category_label string")


def exchanged(df):
    """What the exchanges of the final plan carry."""
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    parts = plan.split("\n\n")
    return "\n".join(p for p in parts if "Exchange" in p.split("\n")[0] and "Input" in p)


def shuffled_bytes(spark):
    executors = spark._jsc.sc().statusStore().executorList(False)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


# --- rows without a key ---


@pytest.mark.parametrize("copies", [1, 7, 60])
def test_equal_rows_are_shared_out_as_the_quotas_ask(spark, copies):
    rows = [(f"text {i}", "a") for i in range(40)] + [("same", "a")] * copies + [(None, "b")] * copies + [(f"t{i}", "b") for i in range(9)] + [("c", "c")] * 20
    parts = S.split_rows(raw(spark, rows).repartition(5), "category_label", None)
    got = [tuple(r) for r in parts.collect()]
    assert Counter(r[:2] for r in got) == Counter(rows)
    assert parts.columns == ["job_description_text", "category_label", "split"]
    # The same sizes as with a key, class by class.
    keyed = raw(spark, rows).withColumn("id", F.monotonically_increasing_id())
    want = S.split_rows(keyed, "category_label", "id").groupBy("category_label", "split").count()
    assert Counter(r[1:] for r in got) == Counter({(r["category_label"], r["split"]): r["count"] for r in want.collect()})
    again = S.split_rows(raw(spark, rows[::-1]).repartition(3), "category_label", None)
    assert Counter(got) == Counter(tuple(r) for r in again.collect())


@pytest.mark.parametrize("cap", [None, 1, 11, 30])
def test_prepare_without_key(spark, cap):
    rows = [(f"text {i}", "ab"[i % 2]) for i in range(40)] + [("same", "a")] * 50
    ready = P.prepare(raw(spark, rows), cap=cap)
    got = ready.conversations.collect()
    sizes = Counter(r["split"] for r in got)
    n = 90
    test = -(-n * 15 // 100)
    validation = -(-(n - test) * 15 // 100)
    whole = {"test": test, "validation": validation, "train": n - test - validation}
    assert sizes == {k: min(v, cap or v) for k, v in whole.items()}
    if cap is None:
        assert Counter(r["messages"][0]["content"].rsplit(": ", 1)[1] for r in got) == Counter(t for t, _ in rows)
    ids = {}
    for r in got:
        ids.setdefault(r["row_id"], set()).add(r["messages"][0]["content"])
    assert all(len(texts) == 1 for texts in ids.values())


def test_prepare_without_key_moves_no_text(spark):
    text = F.concat(F.repeat(F.lit("long text "), 1000), F.col("id").cast("string"))
    df = spark.range(3000).select(text.alias("job_description_text"), F.concat(F.lit("c"), F.col("id") % 3).alias("category_label"))
    before = shuffled_bytes(spark)
    ready = P.prepare(df, cap=500)
    assert ready.conversations.count() == 500 + 450 + 383
    assert "job_description_text" not in exchanged(ready.conversations) and "messages" not in exchanged(ready.conversations)
    ready.conversations.write.format("noop").mode("overwrite").save()
    # All stages together moved a small part of the 30 MB of text.
    assert shuffled_bytes(spark) - before < 2_000_000


def test_one_text_stands_for_copies_across_a_cut(spark):
    df = spark.range(3000).select(F.repeat(F.lit("long text "), 1000).alias("job_description_text"), F.concat(F.lit("c"), F.col("id") % 3).alias("category_label"))
    before = shuffled_bytes(spark)
    assert P.prepare(df.repartition(8), cap=None).conversations.groupBy("split").count().count() == 3
    # The repartition moves all texts in each of two readings; a text for each class and task comes on top.
    assert shuffled_bytes(spark) - before < 10_000_000


def test_content_digest(spark):
    rows = [("a", None, [1, 2], 1.5), (None, "a", [1, 2], 1.5), ("a", None, [1, 2], 1.5), ("a,", None, None, None), ("a", ",", None, None), ("-", None, [], float("nan"))]
    df = spark.createDataFrame(rows, "x string, y string, z array<int>, w double")
    ids = [r[0] for r in df.select(content_digest(df)).collect()]
    assert ids[0] == ids[2] and len(set(ids)) == 5


# --- first rows in order ---


def plain_first(rows, group, order, n):
    out, seen = [], Counter()
    for r in sorted(rows, key=lambda r: tuple((r[c] is not None, r[c] or 0) for c in order)):
        g = tuple(r[c] for c in group)
        if seen[g] < n:
            seen[g] += 1
            out.append(r)
    return out


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_first_in_order(spark, n):
    # One group holds a third of the rows and more.
    rows = [{"g": "hot" if i % 3 else f"g{i % 30}", "h": None if i % 5 else i % 2, "at": (i * 7919) % 4001, "pos": i % 3, "text": f"t{i}"} for i in range(12_000)]
    df = spark.createDataFrame(rows, "g string, h int, at int, pos int, text string").repartition(7)
    got = [r.asDict() for r in first_in_order(df, ["g", "h"], ["at", "pos", "text"], n).collect()]
    key = lambda r: (r["text"], r["at"])
    assert sorted(got, key=key) == sorted(plain_first(rows, ["g", "h"], ["at", "pos", "text"], n), key=key)


def test_ties_and_equal_rows_in_order(spark):
    rows = [("g", None, "x")] * 3 + [("g", 1, "same")] * 10 + [("g", 1, "other")] + [("g", 2, "late")] + [(None, 1, "y")] * 4
    df = spark.createDataFrame(rows, "g string, at int, text string").repartition(4)
    for n in range(1, 16):
        got = [tuple(r) for r in first_in_order(df, ["g"], ["at"], n).collect()]
        assert Counter(r[0] for r in got) == {"g": min(n, 15), None: min(n, 4)}
        assert not Counter(got) - Counter(rows)
        assert sorted((r[1] or 0) for r in got if r[0]) == sorted((r[1] or 0) for r in rows if r[0])[:n]
        assert Counter(got) == Counter(tuple(r) for r in first_in_order(df.repartition(2), ["g"], ["at"], n).collect())


def test_a_large_quota_moves_no_text(spark):
    text = F.concat(F.repeat(F.lit("long text "), 300), F.col("id").cast("string"))
    group = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50))
    df = spark.range(18_000).select(group.alias("category"), F.lit("en").alias("language"), (F.col("id") % 100).alias("attempt"), F.col("id").alias("pos"), text.alias("text"))
    before = shuffled_bytes(spark)
    kept = L.quota_cap(df, L.COMBINATION, ["attempt", "pos"], 5000)
    assert "text" not in exchanged(kept)
    assert kept.count() == 12_000 + 5000
    assert shuffled_bytes(spark) - before < 5_000_000


# --- batches ---


def recording(folder):
    def open_predictor():
        def predict(prompts):
            with open(f"{folder}/{os.getpid()}", "a") as f:
                f.write("|".join(prompts) + "\n")
            return [f"{p}!" for p in prompts]

        return predict

    return open_predictor


def batches(folder):
    return sorted(line.rstrip("\n") for f in os.listdir(folder) for line in open(f"{folder}/{f}"))


@pytest.mark.parametrize("n, size, per_task", [(0, 4, 2), (1, 4, 2), (103, 4, 3), (64, 8, 1), (50, 1, 7), (30, 100, 2)])
def test_a_predictor_gets_the_batches_that_are_assigned(spark, tmp_path, n, size, per_task):
    df = spark.range(n).select(F.col("id").alias("k"), F.concat(F.lit("p"), "id").alias("prompt")).repartition(5)
    folder, kept = tmp_path / "seen", Ledger.open(str(tmp_path / "ledger"), 0, 3)
    folder.mkdir()
    made = Q.predict_in_batches(df, "k", "prompt", recording(str(folder)), size, ledger=kept, task_batches=per_task)
    got = {r["k"]: (r["batch_id"], r["raw_output"]) for r in made.collect()}
    assigned = {r["k"]: r["batch_id"] for r in Q.assign_batches(df, "k", size).collect()}
    assert {k: b for k, (b, _) in got.items()} == assigned
    assert all(out == f"p{k}!" for k, (_, out) in got.items())
    order = {r["k"]: r["d"] for r in df.select("k", digest("k", S.SALT).alias("d")).collect()}
    want = {}
    for k in sorted(order, key=lambda k: (order[k], k)):
        want.setdefault(assigned[k], []).append(f"p{k}")
    assert batches(folder) == sorted("|".join(b) for b in want.values())
    # Computed again, and over the same ledger: no batch is asked for twice.
    made.collect()
    Q.predict_in_batches(df, "k", "prompt", recording(str(folder)), size, ledger=kept, task_batches=per_task).collect()
    assert len(batches(folder)) == len(want)


def test_runs_start_at_every_multiple(spark):
    df = spark.range(1000).withColumnRenamed("id", "k").repartition(3)
    for size in (1, 10, 333, 999, 1000, 5000):
        runs = rank_parts(df, "k", size, "s", 1)
        placed = runs.place(df, "run").orderBy("_digest", "k").collect()
        assert [r["run"] for r in placed] == [i // size for i in range(1000)]
        assert runs.count == -(-1000 // size)


# --- matrix ---


@pytest.mark.parametrize("labels, block", [(0, 4), (1, 4), (4, 4), (11, 4), (11, 256)])
def test_dense_matrix_in_blocks(spark, labels, block):
    names = [f"l{i:03d}" for i in range(labels)]
    vocab = spark.createDataFrame(list(enumerate(names)), "idx bigint, category string")
    found = [(names[i], names[(i * 3) % labels], i + 1) for i in range(labels)] + [("odd", "l000", 5), ("l000", "odd", 5)]
    pairs = spark.createDataFrame(found, "true_label string, predicted_label string, n bigint")
    cells = E.confusion_dense(pairs, vocab, block).collect()
    got = {(r[0], r[1]): r[2] for r in cells}
    known = {(a, b): n for a, b, n in found}
    assert len(cells) == len(got) == labels**2
    assert got == {(a, b): known.get((a, b), 0) for a in names for b in names}


def test_dense_matrix_of_many_labels(spark):
    vocab = spark.range(12_000).select(F.col("id").alias("idx"), F.concat(F.lit("label "), "id").alias("category"))
    pairs = vocab.select(F.col("category").alias("true_label"), F.col("category").alias("predicted_label"), F.col("idx").alias("n"))
    total = E.confusion_dense(pairs, vocab).agg(F.count(F.lit(1)).alias("cells"), F.sum("n").alias("n")).first()
    assert tuple(total) == (12_000**2, 12_000 * 11_999 // 2)


# --- configuration ---


@pytest.mark.parametrize("bad", ["{oops", "", "[1, 2]", "7", '{"a": 1'])
def test_bad_configuration_fails(spark, bad):
    df = spark.createDataFrame([('{"a": "1"}',), (None,), (bad,)], "config string")
    with pytest.raises(Exception, match="."):
        M.flatten_params(df, "config", "p_").collect()
    loose = M.flatten_params(df, "config", "p_", mode="PERMISSIVE").collect()
    assert ("p_a", "1") in [tuple(r) for r in loose]


def test_good_configuration(spark):
    df = spark.createDataFrame([('{"a": "1", "b": null}',), (None,), ("{}",)], "config string")
    assert sorted(map(tuple, M.flatten_params(df, "config", "p_").collect())) == [("p_a", "1"), ("p_b", None)]
