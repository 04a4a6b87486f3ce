import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelloom.llm import quality_model, quality_rules
from labelloom.llm.op1 import held_out, learn
from tests.llm.helpers import SF, awkward_documents, documents, empty_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_tables_learn_an_interaction():
    rng = np.random.default_rng(2)
    x = rng.uniform(size=(4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_model.fit(x[:3000], y[:3000])
    assert (1, 0) in model.pairs
    assert ((model.score(x[3000:]) > 0.5) == (y[3000:] == 1)).mean() > 0.95


def test_one_kind_of_label_and_no_rows():
    model = quality_model.fit(np.random.default_rng(1).normal(size=(20, 3)), np.ones(20))
    assert np.all(model.score(np.zeros((2, 3))) > 0.9)
    empty = quality_model.fit(np.zeros((0, 3)), np.zeros(0))
    assert np.allclose(empty.score(np.zeros((2, 3))), 0.5)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    scored = quality_model.score_documents(docs, learn(docs, labels)).withColumnRenamed("key", "doc_id")
    rows = scored.join(labels, "doc_id").filter(held_out("doc_id")).collect()
    hit = np.mean([(r.score >= 0.3) == (r.quality == 1) for r in rows])
    assert len(rows) > 50 and hit > 0.95


def test_model_does_not_depend_on_partitions(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    a, b = learn(docs, labels), learn(docs.repartition(7), labels.repartition(3))
    assert all(np.array_equal(x, y) for x, y in zip(a.tables, b.tables)) and a.pairs == b.pairs


def test_awkward_rows_are_scored(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (6, 7)], "doc_id bigint, quality int")
    docs = awkward_documents(spark)
    model = learn(docs, labels)
    rows = quality_model.score_documents(docs, model).collect()
    assert len(rows) == 11 and all(0 <= r.score <= 1 for r in rows)
    kept = quality_model.filter_quality(docs, model, 0.0)
    assert kept.schema == docs.schema and kept.count() == 11
    none = empty_documents(spark)
    assert quality_model.score_documents(none, learn(none, labels.limit(0))).count() == 0


# --- rules ---


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = {}
    for w in windows:
        times[w] = times.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
    )


def counts_of(row):
    return row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words


def test_counts_match_brute_force(spark):
    texts = ["", "a", "a b", "a b c", "a b c a b c", "x x x x x", "a b c d a b c e\na b\na b\n\n\n", "é é é\né é é", "<| # $\n<| # $"]
    texts += [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: r for r in quality_rules.text_statistics(documents(spark, texts)).collect()}
    for i, text in enumerate(texts):
        assert counts_of(got[i]) == plain_counts(text), text[:80]


def test_estimates_match_a_plain_em(spark):
    rng = np.random.default_rng(7)
    truth = rng.random(3000) < 0.8
    right = {"a": (0.95, 0.9), "b": (0.9, 0.8), "c": (0.85, 0.7), "d": (0.8, 0.75)}
    votes = {}
    for r, (good, bad) in right.items():
        hit = rng.random(3000) < np.where(truth, good, bad)
        votes[r] = [None if rng.random() < 0.2 else int(t == h) for t, h in zip(truth, hit)]
    rows = list(zip(*votes.values()))
    table = spark.createDataFrame(rows, "a int, b int, c int, d int").groupBy(*right).agg(F.count(F.lit(1)).alias("n"))
    share, accuracy = quality_rules.estimate(table, list(right))
    assert share == pytest.approx(truth.mean(), abs=0.05)
    for r in right:
        assert accuracy[r] == pytest.approx(right[r], abs=0.08)
    p, acc = 0.5, dict.fromkeys(right, quality_rules.START)
    for _ in range(quality_rules.ROUNDS):
        odds = np.full(3000, np.log(p / (1 - p)))
        for r, v in votes.items():
            g, b = acc[r]
            odds += [0.0 if x is None else np.log(g / (1 - b)) if x else np.log((1 - g) / b) for x in v]
        post = 1 / (1 + np.exp(-odds))
        p = min(0.95, max(0.5, post.mean()))
        for r, v in votes.items():
            said = np.array([x is not None for x in v])
            good = np.array([x == 1 for x in v])
            g = min(0.99, max(0.55, ((post * good).sum() + 1.8) / ((post * said).sum() + 2)))
            b = (((1 - post) * (said & ~good)).sum() + 0.6) / (((1 - post) * said).sum() + 2)
            acc[r] = (g, min(0.99, max(1.01 - g, b)))
    assert share == pytest.approx(p, abs=1e-4) and all(accuracy[r] == pytest.approx(acc[r], abs=1e-3) for r in right)


def test_clean_documents_stay_and_junk_goes(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality_rules.judge(docs).join(labels, "doc_id").filter("NOT base_failed").collect()
    clean, junk = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert np.mean(clean) > 0.98 and np.mean(junk) < 0.5


def test_awkward_documents(spark, capsys):
    judged = quality_rules.judge(awkward_documents(spark))
    judged.explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan
    rows = {r.doc_id: r for r in judged.collect()}
    assert rows[3].n_words == 0 and rows[3].base_failed and not rows[3].kept
    assert rows[6].n_words == 30_000 and rows[6].n_repeat_words == 30_000 and rows[6].base_failed
    assert quality_rules.judge(empty_documents(spark)).count() == 0
