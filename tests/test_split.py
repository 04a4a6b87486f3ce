"""Splits: quotas, permutation, stability, caps, guards."""

import hashlib
import math
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from labelloom.operators import split as S
from labelloom.operators.prepare import prepare


def allot(sizes, keep):
    total = sum(sizes.values())
    base = {c: n * keep // total for c, n in sizes.items()}
    by_rest = sorted(sizes, key=lambda c: (-(sizes[c] * keep % total), c))
    for c in by_rest[: keep - sum(base.values())]:
        base[c] += 1
    return base


def brute_split(rows, test=0.15, val=0.15, seed=42):
    """rows: (key, label) pairs -> {key: part}."""
    groups = defaultdict(list)
    for key, label in rows:
        groups[label].append((hashlib.md5(f"{key}|split|{seed}".encode()).hexdigest(), key))
    sizes = {c: len(g) for c, g in groups.items()}
    n = sum(sizes.values())
    kept = allot(sizes, n - math.ceil(test * n))
    m = sum(kept.values())
    trained = allot(kept, m - math.ceil(val * m))
    parts = {}
    for c, group in groups.items():
        n_test, n_val = sizes[c] - kept[c], kept[c] - trained[c]
        for place, (_, key) in enumerate(sorted(group)):
            parts[key] = "test" if place < n_test else "validation" if place < n_test + n_val else "train"
    return parts


def frame(spark, sizes):
    rows = [(i, f"c{c}") for i, c in enumerate(c for c, n in enumerate(sizes) for _ in range(n))]
    return rows, spark.createDataFrame(rows, "id bigint, label string")


@pytest.mark.parametrize("sizes", [[90, 90, 90], [600, 5, 5, 290], [2, 2, 2, 100], [1080], [7, 11, 13, 17, 19]])
def test_equals_brute_force(spark, sizes):
    rows, df = frame(spark, sizes)
    got = {r["id"]: r["split"] for r in S.split_rows(df, "label", "id").collect()}
    assert got == brute_split(rows)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(2, 120), min_size=1, max_size=8))
def test_quota_properties(spark, sizes):
    rows, df = frame(spark, sizes)
    parts = S.split_rows(df, "label", "id").collect()
    n = len(rows)
    assert len(parts) == n and {r["id"] for r in parts} == {i for i, _ in rows}
    assert sum(r["split"] == "test" for r in parts) == math.ceil(0.15 * n)
    held = Counter(r["label"] for r in parts if r["split"] == "test")
    for c, size in enumerate(sizes):
        share = size * math.ceil(0.15 * n) / n
        assert abs(held[f"c{c}"] - share) < 1


def test_default_corpus_sizes(spark):
    _, df = frame(spark, [90] * 12)
    sizes = {r["split"]: r["n_rows"] for r in S.split_counts(S.split_rows(df, "label", "id"), "label").collect()}
    assert sizes == {"train": 780, "validation": 138, "test": 162}


def test_independent_of_partitioning(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    seen = []
    for partitions in ("1", "200"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            out = S.split_rows(docs.repartition(int(partitions) // 20 + 1), "lang", "doc_id")
            seen.append(sorted(map(tuple, out.collect())))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert seen[0] == seen[1]


def test_null_labels_are_a_class(spark):
    df = spark.range(200).select("id", F.when(F.col("id") % 4 != 0, "a").alias("label"))
    out = Counter((r["label"], r["split"]) for r in S.split_rows(df, "label", "id").collect())
    assert out[(None, "test")] + out[("a", "test")] == 30
    assert out[(None, "test")] in (7, 8)


def test_groups_stay_together(spark):
    df = spark.range(900).select("id", (F.col("id") % 300).alias("text_id"), (F.col("id") % 300 % 3).alias("label"))
    out = S.split_rows(df, "label", "id", group_key="text_id")
    assert out.groupBy("text_id").agg(F.count_distinct("split").alias("n")).filter("n > 1").count() == 0
    assert out.filter("split = 'test'").count() == 3 * math.ceil(0.15 * 300)


def test_seed_changes_the_permutation(spark):
    _, df = frame(spark, [100, 100])
    first = S.split_rows(df, "label", "id", seed=1).filter("split = 'test'").select("id")
    second = S.split_rows(df, "label", "id", seed=2).filter("split = 'test'").select("id")
    assert first.exceptAll(second).count() > 0


def test_no_shuffle_of_row_texts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = S.split_rows(docs, "lang", "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_strata_guard(spark):
    _, single = frame(spark, [1, 50])
    with pytest.raises(ValueError, match="smallest has 1 rows"):
        S.check_strata(single, "label")
    _, crowded = frame(spark, [2] * 10)
    with pytest.raises(ValueError, match="10 classes"):
        S.check_strata(crowded, "label")
    _, one_class = frame(spark, [3])
    S.check_strata(one_class, "label")


def test_prepare_without_a_key(spark):
    raw = spark.createDataFrame(
        [(f"[ES_ERROR]  text {i}", "b" if i % 3 else "a") for i in range(60)],
        "job_description_text string, category_label string",
    )
    ready = prepare(raw, cap=20)
    rows = ready.conversations.collect()
    sizes = Counter(r["split"] for r in rows)
    assert sizes == {"train": 20, "validation": 8, "test": 9}
    prompts = {r["messages"][0]["content"] for r in rows}
    assert all(p.startswith("Classify the following job description. Job Description: text ") for p in prompts)
    assert [tuple(r) for r in ready.vocabulary.orderBy("idx").collect()] == [(0, "a"), (1, "b")]


def test_prepare_names_the_missing_column(spark):
    with pytest.raises(ValueError, match="Column 'category_label' not found. Available columns"):
        prepare(spark.range(3).selectExpr("'x' as job_description_text"))
