"""Steps that work in pieces, look words up once and leave rows where they are."""

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.operators import bayes, encode, score
from labelloom.operators import translate as R
from labelloom.plans import joins


def test_predictions_come_in_pieces():
    class Captured:
        schema = T.StructType([T.StructField("p", T.StringType())])

        def mapInArrow(self, run, schema):
            return run

    sizes = []

    def open_predictor():
        def predict(prompts):
            sizes.append(len(prompts))
            return [None if p is None else p + "!" for p in prompts]

        return predict

    texts = [None if i % 7 == 0 else str(i) for i in range(1003)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["p"])
    out = list(score.batch_predict(Captured(), "p", open_predictor, 10)(iter([batch, batch.slice(0, 0)])))
    assert max(b.num_rows for b in out) <= score.PIECE_ROWS
    assert sizes == [10] * 100 + [3]
    assert [x for b in out for x in b.column("raw_output").to_pylist()] == [None if t is None else t + "!" for t in texts]


def test_words_are_encoded_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(encode, "PIECE_ROWS", 3)
    words = spark.createDataFrame([("a", 2), ("b", 3)], "word string, token_id int")
    texts = [None, "", "a b", "b x a", "a", None, "", "b b b b b"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string").coalesce(1)
    got = {r.id: r.input_ids for r in encode.encode(rows, "text", words, max_seq_length=4, pad=False).collect()}
    known = {"a": 2, "b": 3}
    assert {i: [known.get(w, 0) for w in t.split(" ")][:4] for i, t in enumerate(texts) if t} == {i: got[i] for i, t in enumerate(texts) if t}


def test_words_are_made_without_lambdas(spark):
    df = spark.createDataFrame([(" A b\t a ",), (None,), ("",)], "t string").select(bayes.features_of(F.col("t")).alias("w"))
    assert [r.w for r in df.collect()] == [["a", "b", "a"], [], []]
    assert "lambda" not in df._jdf.queryExecution().toString()


def test_rows_in_the_source_language_do_not_go_through_the_join(spark, monkeypatch, capsys):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    rows = spark.createDataFrame([("1", "x", "en"), ("2", "x", "es"), ("3", "y", "es"), ("4", "x", None)], "row_key string, text string, target_language string")
    memory = spark.createDataFrame([("x", "es", "X", None, None), ("x", "en", "no", None, None)],
                                   "source_text string, target_language string, translated string, error_code string, message string")
    found = R.translate_from_memory(rows, memory, "row_key")
    assert {r.row_key: (r.status, r.translated) for r in found.collect()} == {
        "1": ("passed", None), "2": ("translated", "X"), "3": ("error", None), "4": ("error", None)}
    found.explain()
    assert "Union" in capsys.readouterr().out
