"""Word files, live run tables, and naive Bayes as tables."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import IDF, CountVectorizer, StringIndexer
from pyspark.sql import functions as F

from labelloom.operators import bayes as B
from labelloom.operators import encode as C
from labelloom.operators import metrics as R
from labelloom.plans import wordfiles as W
from labelloom.plans.shared import settle
from labelloom.streaming import run_tables as T

# --- words ---


def vocabulary(spark, n):
    rows = [(f"w{i}", i) for i in range(n)] + [("w3", 1), ("w3", 2), ("größe", 7), ("", 9), (None, 8)]
    return settle(spark.createDataFrame(rows, "word string, token_id int").repartition(3))


@pytest.mark.parametrize("files", [1, 4, 50])
def test_word_files(spark, files):
    known = W.write_word_files(vocabulary(spark, 500), files=files)
    asked = pa.array([f"w{i}" for i in range(-3, 520)] + ["größe", "", "W1"])
    want = [i if 0 <= i < 500 and i != 3 else 1 if i == 3 else -5 for i in range(-3, 520)] + [7, 9, -5]
    assert known.ids(asked, -5).tolist() == want
    assert known.ids(pa.array([], pa.string()), 0).tolist() == []


def test_words_of_one_hash_are_told_apart(spark, monkeypatch, tmp_path):
    # All words share a hash, as some do among very many.
    one = pa.table({"hash": pa.array([7] * 5, pa.int64()), "word": ["a", "b", "b", "c", "d"], "id": pa.array([1, 2, 9, 3, 4], pa.int32())})
    with pa.OSFile(str(tmp_path / "000000.arrow"), "wb") as sink, pa.ipc.new_file(sink, one.schema) as out:
        out.write_batch(one.to_batches()[0])
    monkeypatch.setattr(W, "word_hashes", lambda words: np.full(len(words), 7, np.int64))
    assert W.WordFiles(str(tmp_path), 1).ids(pa.array(["d", "x", "b", "a"]), 0).tolist() == [4, 0, 2, 1]


def test_rows_of_one_key_are_encoded_alike_by_one_file_and_many(spark):
    rows = [(1, "w1 w3 nothing w2"), (1, "w4"), (1, "w4"), (2, None), (3, ""), (None, "größe w1 w1")]
    df = spark.createDataFrame(rows, "id bigint, t string")
    known = vocabulary(spark, 10)
    got = {}
    for files in (1, 7):
        encoded = C.encode(df, "t", W.write_word_files(known, files=files), "id", 6, pad=False)
        got[files] = sorted(map(str, encoded.collect()))
    assert got[1] == got[7] and len(got[1]) == 6
    assert [list(r["input_ids"]) for r in encoded.filter("id = 1").orderBy(F.size("input_ids")).collect()] == [[4], [4], [1, 1, 0, 2]]


def test_long_texts_are_cut_exactly(spark):
    texts = ["x " * 40, "x" * 500 + " a b c", " " * 300 + "a b c d e f", "a  b\n" * 100, "a " + "y" * 400, " ".join("abcdefgh" * 20), "é" * 161]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for limit in (1, 3, 10):
        got = df.select(F.slice(F.split(C.first_words(F.col("t"), limit), " "), 1, limit).alias("w")).collect()
        assert [r["w"] for r in got] == [t.split()[:limit] for t in texts]


# --- run tables ---


def log_events(spark, n, runs=2):
    logs = F.map_from_arrays(F.array(F.lit("loss"), F.lit("eval_loss")), F.array((F.col("id") * 37 % 101).cast("double"), (F.col("id") * 53 % 17).cast("double")))
    return spark.range(n).select(F.concat(F.lit("run"), F.col("id") % runs).alias("run_id"), F.col("id").alias("step"), (F.col("id") / 10).alias("epoch"), logs.alias("logs"))


def streamed(spark, df, path, files):
    df.repartition(files).write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_a_replayed_batch_leaves_the_table_as_it_was(spark, tmp_path):
    df = log_events(spark, 200)
    live = streamed(spark, df, str(tmp_path / "in"), 4)
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")
    query = T.start_run_table(live, table, checkpoint, "r", n=5, available_now=True)
    query.awaitTermination()
    rows = lambda: sorted(map(str, T.read_run_table(spark, table).collect()))
    before = rows()
    assert before == sorted(map(str, R.run_metrics(R.progress_metrics(df, 5), "r", "train").select("run_id", "stage", "key", "value", "step").collect()))
    # The commit of the last batch is lost, so it is delivered again.
    commits = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    assert len(commits) == 4
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    query = T.start_run_table(live, table, checkpoint, "r", n=5, available_now=True)
    query.awaitTermination()
    assert rows() == before


@pytest.mark.parametrize("files", [1, 5])
def test_the_streamed_best_equals_the_batch_one(spark, tmp_path, files):
    df = log_events(spark, 600, 3)
    query = T.start_best_checkpoint(streamed(spark, df, str(tmp_path / "in"), files), str(tmp_path / "t"), str(tmp_path / "c"), save_every=7, available_now=True)
    query.awaitTermination()
    got = {r["run_id"]: (r["best_step"], r["best_value"]) for r in T.best_so_far(spark, str(tmp_path / "t")).collect()}
    want = {}
    for run in ("run0", "run1", "run2"):
        best = R.best_checkpoint(R.eval_metric_filter(df.filter(F.col("run_id") == run)), save_every=7).first()
        want[run] = tuple(best)
    assert got == want


def test_a_stream_goes_on_with_what_it_knows(spark, tmp_path):
    path = str(tmp_path / "in")
    df = log_events(spark, 100, 1)
    df.filter("step < 50").coalesce(1).write.parquet(path)
    live = spark.readStream.schema(df.schema).parquet(path)
    for part in (None, df.filter("step >= 50")):
        if part is not None:
            part.coalesce(1).write.mode("append").parquet(path)
        T.start_best_checkpoint(live, str(tmp_path / "t"), str(tmp_path / "c"), save_every=1, available_now=True).awaitTermination()
        seen = df if part is not None else df.filter("step < 50")
        best = R.best_checkpoint(R.eval_metric_filter(seen), save_every=1).first()
        assert tuple(T.best_so_far(spark, str(tmp_path / "t")).first())[1:] == tuple(best)


# --- naive Bayes ---


def corpus(spark, n, labels, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        label = int(rng.integers(labels))
        words = [f"w{int(x)}" for x in rng.zipf(1.3, int(rng.integers(1, 25))) % 50] + [f"own{label}"] * int(rng.random() < 0.3)
        rows.append((i, " ".join(words), f"l{label:04d}"))
    return spark.createDataFrame(rows, "id bigint, text string, label string")


def array_model(train, test):
    """The array model over the same words."""
    words = lambda df: df.withColumn("words", B.features_of(F.col("text")))
    count = CountVectorizer(inputCol="words", outputCol="tf").fit(words(train))
    index = StringIndexer(inputCol="label", outputCol="y", stringOrderType="alphabetAsc").fit(train)
    weigh = IDF(inputCol="tf", outputCol="x").fit(count.transform(words(train)))
    bayes = NaiveBayes(featuresCol="x", labelCol="y").fit(index.transform(weigh.transform(count.transform(words(train)))))
    out = bayes.transform(weigh.transform(count.transform(words(test))))
    return {r["id"]: index.labels[int(r["prediction"])] for r in out.collect()}


@pytest.mark.parametrize("labels", [2, 7, 60])
def test_tables_predict_as_arrays_do(spark, labels):
    df = corpus(spark, 500, labels)
    train, test = df.filter("id % 3 > 0"), df.filter("id % 3 = 0")
    got = {r["id"]: r["predicted_label"] for r in B.classify_by_table(B.fit_bayes(train, "text", "label"), test, "text", "id").collect()}
    assert got == array_model(train, test)


def test_many_labels_and_buckets(spark, tmp_path):
    df = spark.range(4000).select("id", F.concat(F.lit("common word"), F.col("id") % 2000, F.lit(" common")).alias("text"), F.concat(F.lit("l"), F.lpad((F.col("id") % 2000).cast("string"), 4, "0")).alias("label"))
    model = B.fit_bayes(df.filter("id < 2000"), "text", "label", buckets=10**7)
    model.save(str(tmp_path / "m"))
    again = B.BayesTables.load(spark, str(tmp_path / "m"))
    assert again.buckets == 10**7 and again.labels.rows == 2000
    out = B.classify_by_table(again, df.filter("id >= 2000"), "text", "id")
    assert out.columns == ["id", "text", "label", "predicted_label"]
    assert out.filter("label = predicted_label").count() == 2000


def test_odd_rows(spark):
    train = spark.createDataFrame([("a a b", "x"), ("b c", "y"), (None, "y"), ("d", None), ("", "y")], "t string, l string")
    model = B.fit_bayes(train, "t", "l")
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "zzz"), (4, "C c"), (5, "")], "k int, t string")
    got = {r["k"]: r["predicted_label"] for r in B.classify_by_table(model, df, "t", "k").collect()}
    assert got == {1: "x", 2: "y", 3: "y", 4: "y", 5: "y"}
    none = B.fit_bayes(train.limit(0), "t", "l")
    assert {r["predicted_label"] for r in B.classify_by_table(none, df, "t", "k").collect()} == {None}
    assert B.classify_by_table(model, df.limit(0), "t", "k").count() == 0
