"""Metric feed, streaming, artifact checks, readers and writers."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.operators import artifacts as A
from labelloom.operators import metrics as R
from labelloom.schemas import METRICS, RAW_ROWS, TRAIN_LOG_EVENTS
from labelloom.sources import readers as IN
from labelloom.sources import writers as OUT
from labelloom.streaming.progress import start_metric_stream

EVENTS = [
    (5, 0.1, {"loss": 2.0, "learning_rate": 0.5, "train_speed": 9.0, "eval_loss": 1.0, "note": None, "epoch": 0.1}),
    (6, 0.2, {"loss": 1.0, "eval_accuracy": 0.5}),
    (10, None, {"loss": 3.0}),
    (15, 0.3, None),
]


@pytest.fixture
def events(spark):
    return spark.createDataFrame(EVENTS, TRAIN_LOG_EVENTS)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_train_filter(events):
    assert rows(R.train_metric_filter(events, 5)) == [
        (5, "epoch", 0.1), (5, "learning_rate", 0.5), (5, "loss", 2.0), (5, "train_speed", 9.0), (10, "loss", 3.0),
    ]


RENAMED = [
    (5, "epoch", 0.1), (5, "learning_rate", 0.5), (5, "train_epoch", 0.1), (5, "train_learning_rate", 0.5),
    (5, "train_loss", 2.0), (5, "train_speed", 9.0), (10, "train_loss", 3.0),
]
EVALUATED = [(5, "eval_loss", 1.0), (6, "eval_accuracy", 0.5)]


def test_rename_and_eval(events):
    assert rows(R.train_metric_rename(events.filter("step <> 15"), 5)) == RENAMED
    assert rows(R.eval_metric_filter(events)) == EVALUATED
    assert rows(R.progress_metrics(events.filter("step <> 15"), 5)) == sorted(RENAMED + EVALUATED)


def test_stream_equals_batch_and_resumes(spark, events, tmp_path):
    source, out, mark = (str(tmp_path / d) for d in ("in", "out", "mark"))

    def feed(df):
        df.write.mode("append").json(source)
        live = spark.readStream.schema(TRAIN_LOG_EVENTS).json(source)
        start_metric_stream(live, out, mark, 5, available_now=True).awaitTermination()
        return rows(spark.read.schema("step bigint, key string, value double").parquet(out))

    assert feed(events.filter("step = 5")) == [r for r in sorted(RENAMED + EVALUATED) if r[0] == 5]
    assert feed(events.filter("step in (6, 10)")) == sorted(RENAMED + EVALUATED)


def test_best_checkpoint(spark):
    values = [(20, 0.5), (40, 0.3), (50, 0.1), (60, 0.3)]
    metrics = spark.createDataFrame([(s, "eval_loss", v) for s, v in values], "step bigint, key string, value double")
    assert rows(R.best_checkpoint(metrics, "eval_loss", 20)) == [(40, 0.3)]
    assert R.best_checkpoint(metrics, "eval_f1", 20).isEmpty()


def test_log_patterns(spark):
    line = "{'loss': 1.5, 'eval_loss': 2} {'loss': 1e-05, 'eval_accuracy': 0.9, 'x_loss': 7} {'loss': 1.2.3}"
    got = rows(R.extract_log_metrics(spark.createDataFrame([(line,)], "line string"), "line"))
    assert [r for r in got if r[2] is not None] == [
        ("eval:accuracy", 0, 0.9), ("eval:loss", 0, 2.0), ("train:loss", 0, 1.5), ("train:loss", 1, 1.0),
    ]
    assert [r for r in got if r[2] is None] == [("train:loss", 2, None)]


def test_configurations(spark):
    df = spark.createDataFrame([('{"epoch": 2, "lr": 2e-4, "bf16": true}',)], "c string")
    flat = dict(rows(R.flatten_params(df, "c", "ft_train_")))
    assert flat == {"ft_train_epoch": "2", "ft_train_lr": "2e-4", "ft_train_bf16": "true"} or flat["ft_train_epoch"] == "2"
    parsed = R.parse_config(df, "c")
    assert rows(R.flatten_params(parsed, "c", "p_")) == sorted((k.replace("ft_train_", "p_"), v) for k, v in flat.items())


KEYS = ["m/", "m/a.txt", "m/sub/model.tar.gz", "m/sub/", "mm/x", "m/z/model.tar.gz", "m/my_config.json.bak"]


@pytest.fixture
def files(spark):
    return spark.createDataFrame([(k,) for k in KEYS], "key string")


@pytest.mark.parametrize("prefix", ["m", "m/", "m//"])
def test_list_prefix(files, prefix):
    assert rows(A.list_prefix(files, prefix).select("relative_path")) == [
        ("a.txt",), ("my_config.json.bak",), ("sub/model.tar.gz",), ("z/model.tar.gz",),
    ]


def test_empty_prefix_lists_all(files):
    assert A.list_prefix(files, "").count() == 5


def test_suffix_and_required(files):
    assert rows(A.pick_by_suffix(files)) == [("m/sub/model.tar.gz",)]
    assert A.pick_by_suffix(files, ".zip").isEmpty()
    assert rows(A.missing_required(files)) == [("pytorch_model.bin", 7), ("tokenizer.json", 7)]
    assert rows(A.missing_required(files.limit(0), ["a"])) == [("a", 0)]


@pytest.mark.parametrize(
    "uri,expected",
    [
        ("s3://bucket/a/b/c.jsonl", ("bucket", "a/b/c.jsonl", "s3://bucket/a/b", "c.jsonl")),
        ("s3://bucket/", ("bucket", "", "s3://bucket", "")),
        ("bucket/key", ("bucket", "key", "bucket", "key")),
    ],
)
def test_parse_uri(spark, uri, expected):
    assert tuple(spark.range(1).select(A.parse_uri(F.lit(uri)).alias("u")).first()["u"]) == expected


# --- storage ---

RECORDS = [
    {"job_description_text": 'a "b", c\nd', "category_label": "é", "source_language": "en", "target_language": None},
    {"job_description_text": "x", "category_label": "y", "source_language": "en", "target_language": "fr"},
]


def as_rows(df):
    return sorted((tuple(r[c] for c in RAW_ROWS.names) for r in df.collect()), key=str)


EXPECTED = sorted((tuple(r[c] for c in RAW_ROWS.names) for r in RECORDS), key=str)


def test_load_dispatch(spark, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("a.jsonl", "b.json", "c.json", "d.data")}
    lines = "".join(json.dumps(r, ensure_ascii=False) + "\n" for r in RECORDS)
    for name, text in {
        "a.jsonl": lines, "b.json": json.dumps(RECORDS, indent=2), "c.json": lines, "d.data": json.dumps(RECORDS),
    }.items():
        with open(paths[name], "w", encoding="utf-8") as f:
            f.write(text)
    for path in paths.values():
        assert as_rows(IN.load_raw(spark, path, RAW_ROWS)) == EXPECTED
        assert as_rows(IN.load_raw(spark, path)) == EXPECTED


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "rows.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write('job_description_text,category_label,source_language,target_language\n"a ""b"", c\nd",é,en,\nx,y,en,fr\n')
    assert as_rows(IN.load_raw(spark, path, RAW_ROWS)) == EXPECTED


def test_named_and_unknown(spark):
    spark.createDataFrame(RECORDS, RAW_ROWS).createOrReplaceTempView("known_rows")
    assert as_rows(IN.load_raw(spark, "known_rows")) == EXPECTED
    with pytest.raises(ValueError, match="Could not load dataset from some/unknown"):
        IN.load_raw(spark, "some/unknown")


def test_jsonl_keeps_nulls_and_letters(spark, tmp_path):
    path = str(tmp_path / "out")
    OUT.write_jsonl(spark.createDataFrame(RECORDS, RAW_ROWS), path)
    lines = [json.loads(r["value"]) for r in spark.read.text(path).collect()]
    assert sorted(lines, key=str) == sorted(RECORDS, key=str)
    assert any("é" in r["value"] for r in spark.read.text(path).collect())


def test_splits_skip_empty_parts(spark, tmp_path):
    path = str(tmp_path / "splits")
    rows_ = [(s, [("user", "u"), ("assistant", "a")]) for s in ("train", "train", "test")]
    df = spark.createDataFrame(rows_, "split string, messages array<struct<role:string,content:string>>")
    OUT.write_splits(df, path)
    assert sorted(d for d in os.listdir(path) if d.startswith("split=")) == ["split=test", "split=train"]
    files = [f for f in os.listdir(f"{path}/split=train") if f.endswith(".json")]
    text = "".join(open(f"{path}/split=train/{f}").read() for f in files)
    assert all(list(json.loads(x)) == ["messages"] for x in text.splitlines()) and len(text.splitlines()) == 2


def test_vocabulary_file(spark, tmp_path):
    path = str(tmp_path / "vocabulary")
    labels = spark.createDataFrame([("b",), ("é",), ("a",), ("B",)], "category string")
    assert OUT.write_vocabulary(labels, path)
    back = IN.read_vocabulary(spark, path).orderBy("idx").collect()
    assert [(r["idx"], r["category"]) for r in back] == list(enumerate(sorted(["b", "é", "a", "B"])))
    assert not OUT.write_vocabulary(labels.limit(0), str(tmp_path / "none"))
    assert not os.path.exists(tmp_path / "none")


def test_templates(spark, tmp_path):
    path = str(tmp_path / "templates.json")
    with open(path, "w") as f:
        json.dump({"Cook": ["one", "two"], "Pilot": ["three"], "Clerk": []}, f, indent=4)
    assert rows(IN.read_templates(spark, path)) == [("Cook", 0, "one"), ("Cook", 1, "two"), ("Pilot", 0, "three")]
    with open(path, "w") as f:
        f.write("{broken")
    assert IN.read_templates(spark, path).isEmpty()
    assert IN.read_templates(spark, str(tmp_path / "absent.json")).isEmpty()


def test_run_metrics_replace_their_stage(spark, tmp_path):
    path = str(tmp_path / "runs")
    first = spark.createDataFrame([("n", 1.0)], "key string, value double")
    OUT.write_run_metrics(first, path, "r1", "prepare")
    OUT.write_run_metrics(first.withColumn("step", F.lit(3)), path, "r1", "train")
    OUT.write_run_metrics(first.withColumn("value", F.lit(2.0)), path, "r1", "prepare")
    back = spark.read.schema(METRICS).parquet(path).select(*METRICS.names)
    assert sorted(map(tuple, back.collect()), key=str) == [("r1", "prepare", "n", 2.0, None), ("r1", "train", "n", 1.0, 3)]


def test_list_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.bin").write_bytes(b"12345")
    got = IN.list_files(spark, str(tmp_path)).collect()
    assert [(os.path.basename(r["key"]), r["size"]) for r in got] == [("a.bin", 5)]


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert {r["split"] for r in entry.entry(spark).collect()} == {"train", "validation", "test"}
    assert set(entry.oracle_sql()) <= set(entry.queries())
