"""Readers that keep every row, single external calls, and edges of generation, splits and training."""

import json
import os

import pytest
from pyspark.sql import functions as F

from labelloom.operators import encode, evaluate, generate, prepare, responses, score, split, translate
from labelloom.plans import ordering, shared
from labelloom.sources import readers, writers


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


# --- readers ---


def test_a_folder_of_both_kinds_keeps_all_rows(spark, tmp_path):
    write(tmp_path / "a.json", '{"a": 1}\n\n{"a": 2}\n')
    write(tmp_path / "b.json", '[{"a": 3},\n {"a": 4}]')
    write(tmp_path / "c.json", '{\n  "a": 5,\n  "b": "x"\n}\n')
    write(tmp_path / "d.json", '{"a": 6}')
    rows = readers.read_any_json(spark, str(tmp_path), "a int, b string").collect()
    assert sorted((r.a, r.b) for r in rows) == [(1, None), (2, None), (3, None), (4, None), (5, "x"), (6, None)]
    assert readers.load_raw(spark, str(tmp_path)).count() == 6


@pytest.mark.parametrize("name, text", [("a.jsonl", '{"a": 1}\n{"a": broken\n'), ("a.json", '{"a": 1}\n{"a": broken\n'), ("b.json", '[{"a": 1}, {"a" 2}]')])
def test_malformed_json_fails(spark, tmp_path, name, text):
    write(tmp_path / name, text)
    with pytest.raises(Exception, match="(?i)malformed|corrupt"):
        readers.load_raw(spark, str(tmp_path / name), "a int").collect()


def test_malformed_lines_can_be_kept(spark, tmp_path):
    write(tmp_path / "a.jsonl", '{"a": 1}\n{"a": broken\n')
    rows = readers.load_raw(spark, str(tmp_path / "a.jsonl"), "a int, _corrupt_record string", mode="PERMISSIVE").collect()
    assert [(r.a, r._corrupt_record) for r in rows] == [(1, None), (None, '{"a": broken')]


def test_single_line_csv_through_load_raw(spark, tmp_path):
    write(tmp_path / "a.csv", 'a,b\n1,x\n2,"y ""z"""\n')
    rows = readers.load_raw(spark, str(tmp_path / "a.csv"), multiline=False).collect()
    assert [tuple(r) for r in rows] == [("1", "x"), ("2", 'y "z"')]


# --- one call per row ---


def counting(folder):
    def open_client():
        def call(text, source, target):
            with open(os.path.join(folder, f"{os.getpid()}-{id(text)}-{os.urandom(6).hex()}"), "w"):
                pass
            if "2" in text:
                raise RuntimeError("refused")
            return f"{target}> {text}"

        return call

    return open_client


def test_a_client_is_called_once_per_foreign_row(spark, tmp_path):
    templates = spark.createDataFrame([("c", i, f"Text {i}. More of it. End") for i in range(5)], "category string, template_idx bigint, template string")
    categories = generate.category_frame(spark, ["c"])
    step = translate.translate_with(counting(str(tmp_path)), wait=lambda s: None)
    run = generate.generate_run(templates, categories, ["en", "fr", "es"], 8, {"c": ["x"]}, step)
    rows, stats, errors = run.rows.collect(), run.statistics.first(), run.errors.collect()
    assert len(rows) == 24 and len(os.listdir(tmp_path)) == 16
    assert stats.attempted == 16 and stats.successful + stats.failed == 16
    assert sum(e.n for e in errors) == stats.failed > 0


def test_evaluate_scores_every_prompt_once(spark, tmp_path):
    folder = str(tmp_path)

    def open_predictor():
        def predict(prompts):
            for _ in prompts:
                open(os.path.join(folder, os.urandom(8).hex()), "w").close()
            return [p + " en" for p in prompts]

        return predict

    rows = spark.range(50).select(F.col("id").alias("row_id"), F.lit("p").alias("input_text"), F.lit("en").alias("true_label"))
    scored = score.batch_predict(rows, "input_text", open_predictor).withColumn("predicted_label", F.lit("en"))
    labels = spark.createDataFrame([(0, "en"), (1, "fr")], "idx bigint, category string")
    result = evaluate.evaluate(scored.withColumn("predicted_label", F.trim(F.substr("raw_output", F.lit(2)))), labels)
    for frame in (result.summary, result.report, result.confusion, result.metrics, result.examples):
        frame.collect()
    assert result.summary.first().accuracy == 1.0 and len(os.listdir(folder)) == 50


def test_prepare_reads_the_source_twice(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(frames):
        for f in frames:
            seen.add(len(f))
            yield f

    rows = spark.range(400).select(
        F.col("id").alias("row_id"), F.concat(F.lit("text "), "id").alias("job_description_text"), (F.col("id") % 4).cast("string").alias("category_label")
    )
    source = rows.mapInPandas(count, rows.schema)
    ready = prepare.prepare(source, key="row_id", cap=60)
    assert ready.vocabulary.count() == 4
    before = seen.value
    assert ready.conversations.count() == 171 and before == 400
    assert seen.value <= 800


# --- edges ---


def test_nothing_is_made_for_no_rows(spark):
    templates = spark.createDataFrame([("c", 0, "A. B. C")], "category string, template_idx bigint, template string")
    categories = generate.category_frame(spark, ["c", "none"])
    skills = generate.skill_frame(spark, {"c": ["x"]})
    assert generate.base_texts(templates, categories, skills, 0).count() == 0
    assert generate.base_texts(templates, categories, skills, 2).count() == 4
    assert ordering.keep_first(spark.range(5).withColumn("g", F.lit(1)), ["g"], 0, "id", "s", 1).count() == 0


def test_slots_in_values_stay(spark):
    row = spark.range(1).select(responses.render_prompt(F.lit("Role {language} {n}"), F.lit("English"), F.lit(3)).alias("p")).first()
    assert "Role {language} {n}" in row.p and "English" in row.p


def test_guard_of_the_second_hold_out(spark):
    rows = spark.range(140).select(F.col("id"), (F.col("id") % 20).cast("string").alias("label"))
    report = split.strata_report(rows, "label").first()
    assert report.can_stratify_test and not report.can_stratify_validation
    assert (report.n_test, report.n_validation, report.n_classes_left) == (21, 18, 20)
    with pytest.raises(ValueError, match="validation part"):
        split.check_strata(rows, "label")
    split.check_strata(rows, "label", val=0.0)
    grouped = rows.withColumn("g", F.lit(1))
    assert split.strata_report(grouped, "label", group_key="g").first().n_rows == 20


def test_null_labels_are_not_learned(spark):
    rows = [("alpha beta", "a"), ("gamma delta", "b"), ("epsilon", None)] * 5
    train = spark.createDataFrame(rows, "text string, label string")
    model = score.train_classifier(train, "text", "label")
    assert {r.predicted_label for r in score.classify(model, train).collect()} == {"a", "b"}
    unlabelled = score.classify(model, train.select("text"))
    assert unlabelled.filter("text = 'alpha beta'").first().predicted_label == "a"


def test_part_files_sort_as_numbers(spark):
    names = ["part-99999-u-c000.snappy.parquet", "part-100000-u-c000.snappy.parquet", "part-100000-u-c001.snappy.parquet", "part-00007-u-c000.snappy.parquet"]
    table = spark.createDataFrame([(n,) for n in names], "name string")
    got = [r.name for r in table.orderBy(ordering.file_order(F.col("name"))).collect()]
    assert got == [names[3], names[0], names[1], names[2]]


def test_row_ids_do_not_depend_on_splits(spark):
    rows = spark.range(500).select((F.col("id") % 490).alias("x"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("t"), "id")).alias("t"))
    a, b = (sorted(map(str, ordering.with_row_id(rows.repartition(n)).collect())) for n in (2, 9))
    assert a == b


def test_words_beyond_the_limit_and_unknown_words(spark):
    vocabulary = spark.createDataFrame([("a", 2), ("b", 3), ("a", 9)], "word string, token_id int")
    rows = spark.createDataFrame([(1, " a  b c " + "a " * 600), (2, ""), (3, None)], "id bigint, text string")
    got = {r.id: r for r in encode.encode(rows, "text", vocabulary, "id", 4).collect()}
    assert list(got[1].input_ids) == [2, 3, 0, 2] and got[1].n_tokens == 4


def test_run_parameters_replace_their_run(spark, tmp_path):
    path = str(tmp_path / "params")
    frame = lambda **kv: spark.createDataFrame([(k, str(v)) for k, v in kv.items()], "key string, value string")
    writers.write_run_params(frame(a=1, b=2), path, "r1")
    writers.write_run_params(frame(a=3), path, "r2")
    writers.write_run_params(frame(a=4), path, "r1")
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("run_id", "key", "value").collect()) == [("r1", "a", "4"), ("r2", "a", "3")]


def test_model_rows_come_shuffled(spark):
    def open_client():
        return lambda body: json.dumps({"generation": "".join(f"--- JD START ---x{i}--- JD END ---" for i in range(5))})

    rows = responses.generate_from_model(generate.category_frame(spark, ["a", "b", "c"]), open_client, {"English": "English"}, n=5, k=5)
    order = [(r.category_label, r.job_description_text) for r in rows.collect()]
    assert len(order) == 15 and order != sorted(order)
    assert order == [(r.category_label, r.job_description_text) for r in rows.collect()]


def test_widths_and_clean_up(spark):
    rows = spark.createDataFrame([(["ab", None], [1, 2], None)], "s array<string>, n array<int>, b binary")
    assert rows.select(shared.row_bytes(rows)).first()[0] == (32 + 2 + 16 + 16) + (32 + 16) + 16
    table = shared.settle(rows, "cleared")
    assert table.df.count() == 1
