"""Nearest neighbours by inner product through collision counting.

Every vector is projected on single random directions, and each direction has one sorted array. A query opens a
window around its own projection in every array. Virtual rehashing widens all windows together, from radius to
radius, over the same arrays; only what a wider window adds is counted. A vector that has fallen into
`threshold` of the windows is verified by its inner product. The search ends when the k-th best verified
vector lies within the radius, or when the radius reaches a bound known from elsewhere.

Inner products become distances by one more component: a vector x of a run with largest norm M is lifted to
(x, sqrt(M^2 - |x|^2)), a query is scaled to M, so the largest product is the least distance. Vectors
are dealt to runs of `SHARD_ROWS` in the order of their norm, so that M is close for all of a run, and a run whose M
cannot reach a query's bound is passed over (by Cauchy and Schwarz, without loss).

A direction holds a vector at distance R within a window of half width `WIDTH` * R with the probability that a
normal variable stays within `WIDTH`; the threshold is the largest number of directions that such a vector
reaches with probability 1 - `MISS`. So `MISS` bounds the expected loss of what lies at the bound itself; what is nearer is lost less
often. Every row is indexed, nothing is fitted.

Two passes: each query searches the run it lies in, whose k-th best score is a bound for the whole table, and then all
others under that bound, in blocks of queries. A task holds one run; queries stream past it. Each
run sends at most k rows a query to the final ranking.

Vectors that are null, zero, or hold a null or non-finite component take no part. Only vectors of one width are compared.
Rows of equal or null id are rows of their own: a query leaves out its own row alone; null ids are ranked last among ties.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloom.llm.common import stored
from labelloom.llm.vectors import usable
from labelloom.plans.joins import lookup_join
from labelloom.plans.ordering import number_rows
from labelloom.plans.shared import settle

K = 20
DIRECTIONS = 48
WIDTH = 1.0
MISS = 0.04
SHARD_ROWS = 16_384
QUERIES_AT_ONCE = 128
WIDEN = 2.0
SEED = 42


def collision_threshold(directions: int = DIRECTIONS, width: float = WIDTH, miss: float = MISS) -> int:
    """The most windows that a vector at the radius falls into with probability 1 - miss."""
    p, below = math.erf(width / math.sqrt(2)), 0.0
    for hits in range(directions + 1):
        below += math.comb(directions, hits) * p**hits * (1 - p) ** (directions - hits)
        if below > miss:
            return max(hits, 1)
    return directions


class Run:
    """Sorted projections of one run of vectors."""

    def __init__(self, vectors: np.ndarray, rows: np.ndarray, ids: np.ndarray, seed: int = SEED):
        self.vectors, self.rows, self.ids = vectors, rows, ids
        self.by_row = np.argsort(rows)
        # Distances are taken in units of the largest component, so no square overflows.
        self.unit = np.abs(vectors).max()
        self.x = vectors / self.unit
        squares = (self.x**2).sum(1)
        self.top = math.sqrt(squares.max())
        self.directions = np.random.default_rng(seed).standard_normal((DIRECTIONS, vectors.shape[1] + 1))
        lifted = np.sqrt(np.maximum(squares.max() - squares, 0))
        values = (self.x @ self.directions[:, :-1].T + lifted[:, None] * self.directions[:, -1]).T
        self.order = np.argsort(values, axis=1, kind="stable")
        self.sorted = np.take_along_axis(values, self.order, axis=1)
        self.threshold = collision_threshold()

    def position(self, row: int) -> int | None:
        at = int(np.searchsorted(self.rows, row, sorter=self.by_row))
        return int(self.by_row[at]) if at < len(self.rows) and self.rows[self.by_row[at]] == row else None

    def nearest(self, queries: np.ndarray, own: list[int], bounds: list[float | None], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query: positions and exact products of its best found, at most k, none below its bound."""
        units = np.abs(queries).max(1)
        q = queries / units[:, None]
        norms = np.sqrt((q**2).sum(1))
        # Squared distance 2 * top^2 - 2 * stretch * product, in units.
        stretch = self.top / norms
        reach = np.array([4.0 if b is None else 2 - 2 * (b / self.unit / u) / (self.top * n) for b, u, n in zip(bounds, units, norms)])
        end = self.top * np.sqrt(np.clip(reach, 0, 4))
        at = (q * stretch[:, None]) @ self.directions[:, :-1].T
        size = len(self.x)
        low = np.stack([np.searchsorted(self.sorted[i], at[:, i]) for i in range(DIRECTIONS)], axis=1)
        high = low.copy()
        counts = np.zeros((len(q), size), np.int16)
        done = np.zeros((len(q), size), bool)
        found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in queries]
        for j, row in enumerate(own):
            place = self.position(row)
            if place is not None:
                done[j, place] = True
        near = np.abs(np.stack([self.sorted[i][np.clip(low[:, i] + k // 2, 0, size - 1)] for i in range(DIRECTIONS)], axis=1) - at)
        radius = np.minimum(np.maximum(np.median(near, axis=1) / WIDTH, 1e-6 * self.top), end)
        slack = 1e-9 * self.top
        active = np.flatnonzero(reach > -1e-9)
        kth = np.full(len(q), -np.inf)
        while len(active):
            half = WIDTH * radius[active] + slack
            lows = np.stack([np.searchsorted(self.sorted[i], at[active, i] - half, "left") for i in range(DIRECTIONS)], axis=1)
            highs = np.stack([np.searchsorted(self.sorted[i], at[active, i] + half, "right") for i in range(DIRECTIONS)], axis=1)
            going = []
            for j, to_low, to_high in zip(active.tolist(), lows, highs):
                wider = [self.order[i, a:b] for i, (a, b) in enumerate(zip(to_low.tolist(), low[j].tolist())) if a < b]
                wider += [self.order[i, a:b] for i, (a, b) in enumerate(zip(high[j].tolist(), to_high.tolist())) if a < b]
                if wider:
                    counts[j] += np.bincount(np.concatenate(wider), minlength=size).astype(np.int16)
                low[j], high[j] = to_low, to_high
                fresh = np.flatnonzero((counts[j] >= self.threshold) & ~done[j])
                if len(fresh):
                    done[j, fresh] = True
                    found[j].append((fresh, self.x[fresh] @ q[j]))
                    seen = np.concatenate([s for _, s in found[j]])
                    if len(seen) >= k:
                        kth[j] = np.partition(seen, len(seen) - k)[-k]
                far = end[j]
                if kth[j] > -np.inf:
                    far = min(far, math.sqrt(max(2 * self.top**2 - 2 * stretch[j] * kth[j], 0.0)))
                if radius[j] < far and not (low[j].max() == 0 and high[j].min() == size):
                    radius[j] = min(radius[j] * WIDEN, far)
                    going.append(j)
            active = np.array(going, int)
        return [self._best(found[j], queries[j], kth[j], norms[j], bounds[j], k) for j in range(len(q))]

    def _best(self, found: list[tuple[np.ndarray, np.ndarray]], query: np.ndarray, kth: float, norm: float, bound: float | None, k: int) -> tuple[np.ndarray, np.ndarray]:
        if not found:
            return np.array([], int), np.array([])
        places, rough = (np.concatenate([f[s] for f in found]) for s in (0, 1))
        places = places[rough >= kth - 1e-12 * self.top * norm]
        exact = products(self.vectors[places], query)
        if bound is not None:
            places, exact = places[exact >= bound], exact[exact >= bound]
        best = np.lexsort((self.ids[places], -exact))[:k]
        return places[best], exact[best]


def products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, summed with extra digits, so that they do not depend on how many are taken at once."""
    return (vectors.astype(np.longdouble) * query).sum(1).astype(np.float64)


NULL_ID = np.iinfo(np.int64).max


def _ids(column: pa.Array) -> np.ndarray:
    """Ids; a null stands behind all others."""
    return column.fill_null(NULL_ID).to_numpy(zero_copy_only=False)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 4096) -> Iterator[tuple[str, bool, pa.RecordBatch]]:
    """Consecutive rows of one run and kind."""
    for whole in batches:
        for start in range(0, whole.num_rows, rows):
            batch = whole.slice(start, rows)
            keys = np.array(batch.column(0).to_pylist(), object)
            own = batch.column(1).to_numpy(zero_copy_only=False)
            first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (own[1:] != own[:-1])])
            for a, b in zip(first, np.r_[first[1:], len(keys)]):
                yield keys[a], bool(own[a]), batch.slice(int(a), int(b - a))


def search_runs(visits: DataFrame, tasks: int, k: int) -> DataFrame:
    """(query, query_id, vec_id, score) of `visits(at, own, row, vec_id, vector, bound)`: members of a run, then its queries."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, run = None, [], None
        for at, own, part in _parts(batches):
            if at != key:
                key, held, run = at, [], None
            if own:
                held.append((_matrix(part.column(4)), part.column(2).to_numpy(), _ids(part.column(3))))
                continue
            if not held:
                continue
            if run is None:
                run = Run(*(np.concatenate([h[s] for h in held]) for s in range(3)))
            for start in range(0, part.num_rows, QUERIES_AT_ONCE):
                some = part.slice(start, QUERIES_AT_ONCE)
                hits = run.nearest(_matrix(some.column(4)), some.column(2).to_pylist(), some.column(5).to_pylist(), k)
                which = np.repeat(np.arange(len(hits)), [len(p) for p, _ in hits])
                places = np.concatenate([p for p, _ in hits]).astype(int)
                asked, ids = some.take(pa.array(which)), run.ids[places]
                yield pa.RecordBatch.from_arrays(
                    [asked.column(2), asked.column(3), pa.array(ids, mask=ids == NULL_ID), pa.array(np.concatenate([s for _, s in hits]))],
                    ["query", "query_id", "vec_id", "score"],
                )

    # Little data and much work: a task for each run and block of queries, not as many as the bytes suggest.
    dealt = visits.select("at", "own", "row", "vec_id", "vector", "bound").repartition(max(tasks, 1), "at").sortWithinPartitions("at", F.desc("own"))
    return dealt.mapInArrow(work, "query bigint, query_id bigint, vec_id bigint, score double")


def nearest_products(table: DataFrame, is_query: Column, k: int = K, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products found for each row that is a query."""
    v = F.col(f"`{vector}`")
    taken = table.filter(usable(v, F.lit(True))).select(
        F.col(f"`{key}`").cast("bigint").alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("asks"), v.cast("array<double>").alias("vector")
    )
    length = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    sized = taken.withColumns({"width": F.size("vector"), "_norm": length})
    rows = number_rows(sized, ["width", F.desc("_norm"), F.xxhash64("vector"), "vec_id", "asks"], "row").drop("_norm")
    placed = stored(rows.withColumn("run", F.floor((F.col("row") - 1) / SHARD_ROWS).cast("int")), "near-rows")
    spans = settle(placed.groupBy("width").agg(F.min("run").alias("_first"), F.max("run").alias("_last")), "near-runs")
    total = int(placed.agg(F.countDistinct("width", "run")).first()[0])
    # With few runs, several tasks hold the same one and take a part of its queries each.
    splits = max(1, math.ceil(2 * table.sparkSession.sparkContext.defaultParallelism / max(total, 1)))
    name = F.concat_ws("|", "width", "run", "split")
    members = placed.select(
        "width", "run", F.explode(F.sequence(F.lit(0), F.lit(splits - 1))).alias("split"), F.lit(True).alias("own"), "row", "vec_id", "vector",
        F.lit(None).cast("double").alias("bound"),
    )
    split = F.pmod(F.xxhash64("row"), F.lit(splits)).cast("int").alias("split")
    queries = placed.filter("asks")

    def visits(asking: DataFrame) -> DataFrame:
        return members.unionByName(asking).withColumn("at", name)

    at_home = queries.select("width", "run", split, F.lit(False).alias("own"), "row", "vec_id", "vector", F.lit(None).cast("double").alias("bound"))
    home = stored(search_runs(visits(at_home), total * splits, k), "near-home")
    enough = home.groupBy("query").agg(F.min("score").alias("bound"), F.count(F.lit(1)).alias("n")).select("query", F.when(F.col("n") >= k, F.col("bound")).alias("bound"))
    bounds = settle(enough.withColumnRenamed("query", "row"), "near-bounds")
    spread = lookup_join(lookup_join(queries, bounds, ["row"], ["row"]), spans, ["width"], ["row"])
    away = spread.select(
        "width", F.explode(F.filter(F.sequence("_first", "_last"), lambda r: r != F.col("run"))).alias("run"), split, F.lit(False).alias("own"), "row", "vec_id", "vector", "bound"
    )
    found = home.unionByName(search_runs(visits(away), total * splits, k)) if total > 1 else home
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
