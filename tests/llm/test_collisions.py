import numpy as np
import pytest
from pyspark.sql import functions as F

import labelloom.llm.collisions as module
from labelloom.llm.collisions import Run, collision_threshold, nearest_products, products
from labelloom.llm.op12 import op12_nearest_vectors
from tests.llm.helpers import SF


def plain(ids, vectors, k=20, every=20):
    """Per query row: [(vec_id, score)] of all other rows, best first."""
    out = {}
    for j, (i, q) in enumerate(zip(ids, vectors)):
        if i is None or i % every:
            continue
        scores = products(vectors, q)
        order = sorted((r for r in range(len(ids)) if r != j), key=lambda r: (-scores[r], ids[r] is None, ids[r] or 0))
        out.setdefault(i, []).append([(ids[r], scores[r]) for r in order[:k]])
    return out


def table(spark, ids, vectors):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in zip(ids, vectors)], "vec_id bigint, embedding array<double>")


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    return {q: [hits[n] for n in range(1, len(hits) + 1)] for q, hits in out.items()}


def recall(got, want):
    hit = total = 0
    for q, (best,) in want.items():
        known = {i for i, _ in got.get(q, [])}
        hit += sum(i in known for i, _ in best)
        total += len(best)
    return hit / total


def check_rows(got, ids, vectors, k=20):
    """Exact scores, in order, without the query itself."""
    at = dict(zip(ids, vectors))
    for q, hits in got.items():
        assert len(hits) == min(k, len(ids) - 1)
        assert all(i != q and s == products(at[i][None, :], at[q])[0] for i, s in hits)
        assert hits == sorted(hits, key=lambda h: (-h[1], h[0]))


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, vectors = [r[0] for r in rows], np.array([r[1] for r in rows], np.float64)
    got = found(op12_nearest_vectors(spark, SF))
    check_rows(got, ids, vectors)
    assert recall(got, plain(ids, vectors)) >= 0.95


@pytest.mark.parametrize("kind", ["even", "clusters", "norms", "copies"])
def test_recall_over_many_runs(spark, monkeypatch, kind):
    rng = np.random.default_rng(5)
    n = 3000
    x = rng.standard_normal((n, 24))
    if kind == "clusters":
        x = rng.standard_normal((40, 24))[rng.integers(0, 40, n)] + 0.2 * x
    if kind == "norms":
        x *= np.exp(rng.standard_normal(n))[:, None]
    if kind == "copies":
        x[: n // 3] = x[0]
    monkeypatch.setattr(module, "SHARD_ROWS", 700)
    ids = list(range(n))
    got = found(nearest_products(table(spark, ids, x), F.col("vec_id") % 20 == 0))
    check_rows(got, ids, x)
    want = plain(ids, x)
    if kind == "copies":
        # Equal scores: the smallest ids, exactly.
        assert got[20] == want[20][0]
    assert recall(got, want) >= 0.9


def test_a_wide_window_finds_everything():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((500, 8))
    run = Run(x, np.arange(500), np.arange(500))
    ((places, scores),) = run.nearest(x[:1], [0], [None], 499)
    assert sorted(places.tolist()) == list(range(1, 500)) and (scores == products(x, x[0])[places]).all()


def test_a_bound_only_leaves_out_what_is_below_it():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((2000, 16))
    run = Run(x, np.arange(2000), np.arange(2000))
    q = rng.standard_normal((1, 16))
    exact = np.sort(products(x, q[0]))[::-1]
    ((_, scores),) = run.nearest(q, [-1], [exact[9]], 20)
    assert len(scores) >= 9 and (scores >= exact[9]).all()
    ((places, _),) = run.nearest(q, [-1], [1e9], 20)
    assert not len(places)


def test_threshold_keeps_the_promised_share():
    rng = np.random.default_rng(4)
    hits = (np.abs(rng.standard_normal((100_000, module.DIRECTIONS))) <= module.WIDTH).sum(1)
    assert abs((hits >= collision_threshold()).mean() - (1 - module.MISS)) < module.MISS


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [2.0, 0.0], None), (None, [2.0, 0.0], 1), (2, None, 1), (3, [0.0, 0.0], 1), (4, [nan, 1.0], 1),
        (5, [inf, 1.0], 1), (6, [None, 1.0], 1), (7, [], 1), (20, [1.0, 1.0, 1.0], 1), (21, [1.0, 1.0, -1.0], 1), (40, [1e300, 1e300], 1), (8, [1e-300, 0.0], 1),
    ]
    clash = "vec_id bigint, embedding array<double>, row int"
    df = spark.createDataFrame(rows, clash).select("*", *[F.lit(1).alias(c) for c in ("width", "run", "bound", "at", "own", "score", "rank", "vector")])
    got = {}
    for r in nearest_products(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    # Two rows with id 0, each with a list of its own in which the other stands.
    assert sorted(got[0], key=lambda x: x[0]) == [
        (1, 40, 1e300), (1, 40, 1e300), (2, 1, 2.0), (2, 1, 2.0), (3, None, 2.0), (3, None, 2.0), (4, 0, 1.0), (4, 0, 1.0), (5, 8, 1e-300), (5, 8, 1e-300),
    ]
    assert got[20] == [(1, 21, 1.0)]
    assert len(got[40]) == 5
    assert set(got) == {0, 20, 40}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert nearest_products(empty, F.col("vec_id") % 20 == 0).count() == 0
    none = spark.createDataFrame([(1, [1.0]), (2, [2.0])], "vec_id bigint, embedding array<float>")
    assert nearest_products(none, F.col("vec_id") % 20 == 0).count() == 0
    alone = spark.createDataFrame([(20, [1.0])], "vec_id bigint, embedding array<float>")
    assert nearest_products(alone, F.col("vec_id") % 20 == 0).count() == 0
