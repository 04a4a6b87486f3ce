"""Joins, numbering and first-n selection, including the paths for large or skewed tables."""

import pytest
from pyspark.sql import functions as F

from labelloom.plans.joins import fits_broadcast, lookup_join
from labelloom.plans.ordering import first_n_per_group, keep_first, number_rows, with_row_id
from labelloom.plans.shared import Settled, measure, settle


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.fixture
def skewed(spark):
    """3,000 rows, a third of them under one key, some keys null or unknown."""
    k = (
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 50 == 1, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 40).cast("string")))
    )
    return spark.range(3000).select("id", k.alias("k"))


@pytest.fixture
def table(spark):
    known = [("hot", 1), (None, 2)] + [(f"k{i}", i) for i in range(0, 40, 2)]
    return spark.createDataFrame(known, "k string, v int")


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_lookup_join_is_the_same_by_every_path(skewed, table, how, null_safe):
    expected = rows(lookup_join(skewed, table, ["k"], ["id"], how, null_safe), "id")
    shuffled = lookup_join(skewed, table, ["k"], ["id"], how, null_safe, max_bytes=0, hot_rows=10**9)
    salted = lookup_join(skewed, table, ["k"], ["id"], how, null_safe, max_bytes=0, hot_rows=100)
    assert rows(shuffled, "id") == expected
    assert rows(salted, "id") == expected
    assert salted.columns == ["k", "id", "v"] if not null_safe else salted.columns == ["id", "k", "v"]


def test_hot_key_is_spread_over_tasks(spark, skewed, table):
    salted = lookup_join(skewed, table, ["k"], ["id"], max_bytes=0, hot_rows=100)
    plan = salted._jdf.queryExecution().optimizedPlan().toString()
    assert "_slot" in plan and "xxhash64" in plan


def test_small_table_is_broadcast(skewed, table):
    plan = lookup_join(skewed, table, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_size_check():
    assert fits_broadcast(Settled(None, 10, 1000))
    assert not fits_broadcast(Settled(None, 10, 10**9))
    assert not fits_broadcast(Settled(None, 10**8, 1000))


def test_settle_measures_and_keeps_rows(spark, skewed):
    stored = settle(skewed)
    assert stored.rows == 3000 and stored.nbytes > 3000 * 8
    assert rows(stored.df, "id") == rows(skewed, "id")
    assert measure(skewed).rows == 3000


def test_settle_of_nothing(spark):
    assert settle(spark.range(0)).rows == 0
    assert settle(spark.createDataFrame([], "a string")).rows == 0
    assert settle(spark.range(5).filter("id > 9").groupBy("id").count()).rows == 0


@pytest.mark.parametrize("partitions", ["1", "5", "64"])
def test_number_rows(spark, skewed, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = rows(number_rows(skewed, [F.col("k").desc(), "id"], "n"), "n")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [r[2] for r in got] == list(range(1, 3001))
    by_id = rows(skewed, "id")
    expected = sorted(by_id, key=lambda r: r[1] or "", reverse=True)
    assert [(r[0], r[1]) for r in got] == expected


def test_row_ids_are_dense(spark, skewed):
    ids = [r["row_id"] for r in with_row_id(skewed.repartition(7)).collect()]
    assert sorted(ids) == list(range(1, 3001))


@pytest.mark.parametrize("n", [1, 7, 5000])
def test_first_n_per_group(spark, skewed, n):
    got = rows(first_n_per_group(skewed, ["k"], [F.col("id").desc()], n, ["id"], spread=4), "id")
    by_key = {}
    for i, k in sorted(rows(skewed, "id"), reverse=True):
        by_key.setdefault(k, []).append((i, k))
    assert got == sorted(r for group in by_key.values() for r in group[:n])


@pytest.mark.parametrize("n", [1, 9, 700, 5000])
def test_keep_first_takes_the_seeded_first_rows(spark, skewed, n):
    import hashlib

    got = rows(keep_first(skewed, ["k"], n, "id", "salt", 3), "id")
    by_key = {}
    for i, k in rows(skewed, "id"):
        by_key.setdefault(k, []).append((hashlib.md5(f"{i}|salt|3".encode()).hexdigest(), i))
    assert got == sorted((i, k) for k, group in by_key.items() for _, i in sorted(group)[:n])
