"""Chat templates, token arrays, prediction extraction, models."""

import pytest
from pyspark.sql import functions as F

from labelloom.operators import encode as C
from labelloom.operators import prepare as P
from labelloom.operators import score as M
from labelloom.plans.shared import Settled, settle

CHAT = [("system", "be brief"), ("user", "hi"), ("assistant", "yo"), ("tool", "zzz"), ("user", "bye")]


@pytest.fixture
def chat(spark):
    return spark.createDataFrame([(1, CHAT)], "id bigint, messages array<struct<role:string,content:string>>")


def test_training_template_drops_other_roles(chat):
    text = chat.select(C.render_train(F.col("messages"), "</s>").alias("t")).first()["t"]
    assert text == "\n\nHuman: hi</s>\n\nAssistant: yo</s>\n\nHuman: bye</s>"


def test_evaluation_template_keeps_bare_system(chat):
    text = chat.select(C.render_eval(F.col("messages"), "</s>").alias("t")).first()["t"]
    assert text == "be brief\n\nHuman: hi</s>\n\nAssistant: yo</s>\n\nHuman: bye</s>\n\nAssistant: "


def test_conversation_columns(spark, chat):
    short = spark.createDataFrame([(2, [("user", "only")])], chat.schema)
    both = chat.unionByName(short)
    assert [(r["prompt"], r["true_label"]) for r in P.prompt_and_label(both).orderBy("id").collect()] == [
        ("be brief", "hi"), ("only", None),
    ]
    assert [r["content"] for r in P.role_contents(both, "user").orderBy("id", "content").collect()] == ["bye", "hi", "only"]
    assert P.filter_valid(both).isEmpty()


@pytest.fixture
def texts(spark):
    rows = [(1, "a b c <eos>"), (2, "b  \n zz b"), (3, ""), (4, None), (5, "a b c a b c a b c")]
    return spark.createDataFrame(rows, "id bigint, t string")


@pytest.fixture
def vocabulary(spark):
    return spark.createDataFrame([("<eos>", 1), ("b", 2), ("a", 3), ("c", 4)], "word string, token_id int")


EXPECTED = {
    1: (4, [3, 2, 4, 1, 1, 1]),
    2: (3, [2, 0, 2, 1, 1, 1]),
    3: (1, [0, 1, 1, 1, 1, 1]),
    4: (0, [1, 1, 1, 1, 1, 1]),
    5: (6, [3, 2, 4, 3, 2, 4]),
}


def encoded(df):
    return {r["id"]: (r["n_tokens"], list(r["input_ids"])) for r in df.collect()}


def test_encode_by_both_lookups(texts, vocabulary):
    shipped = encoded(C.encode(texts, "t", vocabulary, "id", 6))
    large = settle(vocabulary)
    joined = encoded(C.encode(texts, "t", Settled(large.df, 10**9, 10**12), "id", 6))
    assert shipped[5] == EXPECTED[5] and shipped[1] == EXPECTED[1] and shipped[2] == EXPECTED[2]
    assert shipped[3] == joined[3] and shipped[1] == joined[1] and shipped[2] == joined[2] and shipped[5] == joined[5]
    assert shipped[4] == joined[4] == EXPECTED[4]


def test_limit_is_at_most_512(spark, vocabulary):
    long = spark.createDataFrame([(1, "a " * 2000)], "id bigint, t string")
    row = C.encode(long, "t", vocabulary, "id", 1024).first()
    assert len(row["input_ids"]) == row["n_tokens"] == 512


def test_user_tokenizer(texts):
    def open_tokenizer():
        return lambda batch: [[len(w) for w in t.split()] for t in batch]

    got = encoded(C.encode_with(texts, "t", open_tokenizer, pad_id=9, max_seq_length=6))
    assert got[1] == (4, [1, 1, 1, 5, 9, 9]) and got[4] == (0, [9] * 6) and got[5] == (6, [1] * 6)


def test_mask_and_labels(texts, vocabulary):
    rows = C.encode(texts, "t", vocabulary, "id", 6).select(
        "id",
        C.attention_mask(F.col("n_tokens"), F.lit(6)).alias("mask"),
        C.causal_labels(F.col("input_ids")).alias("labels"),
    )
    got = {r["id"]: (list(r["mask"]), list(r["labels"])) for r in rows.collect()}
    # The real end marker of row 1 is ignored together with the padding.
    assert got[1] == ([1, 1, 1, 1, 0, 0], [3, 2, 4, -100, -100, -100])
    assert got[5] == ([1] * 6, [3, 2, 4, 3, 2, 4])


def test_batches_pad_to_their_longest(spark, texts, vocabulary):
    rows = C.encode(texts.withColumn("batch_id", F.floor((F.col("id") - 1) / 2)), "t", vocabulary, "id", pad=False)
    got = {r["id"]: (r["batch_length"], len(r["input_ids"]), sum(r["attention_mask"])) for r in C.pad_batches(rows).collect()}
    assert got == {1: (4, 4, 4), 2: (4, 4, 3), 3: (1, 1, 1), 4: (1, 1, 0), 5: (9, 9, 9)}


@pytest.mark.parametrize(
    "output,mode,expected",
    [
        ("PROMPT Cook\nrest", "length", "Cook"),
        ("PROMPT \n\n Cook \n rest", "length", "Cook"),
        ("ROMPT Cook", "length", "Cook"),
        ("OMPT Cook", "length", "ook"),
        ("PROMPT", "length", ""),
        ("PRO", "length", ""),
        ("OMPT Cook", "prefix", "OMPT Cook"),
        ("PROMPT Cook", "prefix", "Cook"),
    ],
)
def test_extract_prediction(spark, output, mode, expected):
    got = spark.range(1).select(M.extract_prediction(F.lit(output), F.lit("PROMPT"), mode).alias("p")).first()["p"]
    assert got == expected
    if mode == "length":
        assert got == output[len("PROMPT"):].strip().split("\n")[0].strip()


def test_unknown_mode():
    with pytest.raises(ValueError, match="strip_mode"):
        M.extract_prediction(F.lit(1), F.lit(1), "other")


def test_predictor_sees_batches_of_the_given_size(spark):
    def open_predictor():
        return lambda prompts: [f"{p}|{len(prompts)}" for p in prompts]

    df = spark.range(10).select(F.col("id").cast("string").alias("p")).coalesce(1)
    out = [r["raw_output"] for r in M.batch_predict(df, "p", open_predictor, 4).collect()]
    assert out == [f"{i}|{4 if i < 8 else 2}" for i in range(10)]


def test_batches_are_consecutive(spark):
    ids = [r["batch_id"] for r in M.assign_batches(spark.range(10), "id", 4).collect()]
    assert sorted(ids) == [0] * 4 + [1] * 4 + [2] * 2


@pytest.mark.parametrize("logistic", [False, True])
def test_classifier_learns_and_round_trips(spark, logistic, tmp_path):
    words = {"cook": "food kitchen knives", "pilot": "plane sky weather", "nurse": "care ward health"}
    rows = [(i, f"{w} {i % 7}", c) for i, (c, w) in enumerate(list(words.items()) * 20)]
    df = spark.createDataFrame(rows, "id bigint, text string, label string")
    model = M.train_classifier(df, "text", "label", features=256, logistic=logistic)
    M.save_model(model, str(tmp_path / "model"))
    again = M.classify(M.load_model(str(tmp_path / "model")), df)
    assert again.filter("predicted_label = label").count() == 60
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, M.classify(model, df).collect()))
