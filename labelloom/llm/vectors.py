"""Embedding near-duplicates through an inverted multi-index.

Unit vectors are cut in two halves, each with its own codebook; a pair of codewords is a
cell of the product grid. Every vector is filed in its nearest cell. To find its neighbours, a vector
visits every cell that can hold one: in each half, a member lies no farther from its codeword than the
farthest member does, and on the codeword's side of the plane halfway to any other. No cell is left
out for its rank, so no link is lost, and no order of visits is needed. What meets in a cell of the
same label is verified by cosine in double precision.

Runs of cells that hold about `BLOCK_ROWS` vectors of a label are visited as one group, with one
copy of the visitor. Of two groups that can hold neighbours of each other, one visits the other.
Codebooks are fitted on a bounded sample; every vector is indexed.

Equal vectors of a label are one node. Large groups are cut into blocks, and visitors go to
each block, so a task holds one block of vectors and streams the visitors past it.

Vectors that are null, zero, or hold a null or non-finite component, and rows without a
label, link with nothing: no links, their own component. Repeated rows are copies. Vectors of different widths
never link; each width has an index of its own. Columns besides the three that are named are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom.functions.hashing import digest
from labelloom.llm.common import connected_components, stored
from labelloom.plans.joins import lookup_join
from labelloom.plans.shared import settle

MIN_COSINE = 0.93
FIT_ROWS = 20_000
CELL_ROWS = 32
MAX_CODEWORDS = 512
BLOCK_ROWS = 4096
LLOYD_ROUNDS = 12
# Rounding of distances; a cell within it of being possible is visited.
SLACK = 1e-7
GRID_CELLS_AT_ONCE = 2**22


def usable(vector: Column, label: Column) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    longer = F.exists(vector, lambda x: x != 0)
    return F.coalesce(label.isNotNull() & vector.isNotNull() & finite & longer, F.lit(False))


def node_name(vector: Column, label: Column) -> Column:
    """Equal for equal vectors of a label only."""
    plain = F.transform(vector, lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x.cast("double")))
    return F.md5(F.concat_ws("|", label.cast("string"), F.array_join(plain.cast("array<string>"), ",")))


def unit(rows: list | np.ndarray) -> np.ndarray:
    x = np.array(rows, np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def lloyd(x: np.ndarray, k: int, seed: int = 42) -> np.ndarray:
    """Codewords of `x` (at most `k`)."""
    rng = np.random.default_rng(seed)
    words = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(LLOYD_ROUNDS):
        near = distances(x, words).argmin(1)
        sums = np.zeros_like(words)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(words))
        words = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], words)
    return words


def distances(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Squared distances of rows to codewords."""
    return np.maximum((x**2).sum(1)[:, None] - 2 * x @ words.T + (words**2).sum(1)[None, :], 0)


def along(words: np.ndarray) -> np.ndarray:
    """Codewords in their order along the axis on which they differ most, so that near ones are often side by side."""
    if not words.shape[1]:
        # The second half of a vector of one component.
        return words
    axis = np.linalg.svd(words - words.mean(0), full_matrices=False)[2][0]
    return words[np.argsort(words @ axis, kind="stable")]


def least_distances(near: np.ndarray, words: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """Squared distance from each row to the nearest place where a member of each codeword can lie, or less.

    `near` has the squared distances of rows to codewords.
    """
    own = near.argmin(1)
    gap = np.sqrt(distances(words, words))[own]
    plane = np.where(gap > 1e-6, (near - near.min(1)[:, None]) / (2 * np.maximum(gap, 1e-6)), 0)
    return np.maximum(np.sqrt(near) - reach, np.maximum(plane, 0)) ** 2


@dataclass(frozen=True)
class Grid:
    """Codebooks of both halves, the largest distance of a member to each codeword, and the cells of a group."""

    first: np.ndarray
    second: np.ndarray
    reach_first: np.ndarray
    reach_second: np.ndarray
    per_group: int

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = self.first.shape[1]
        return distances(x[:, :cut], self.first), distances(x[:, cut:], self.second)

    def own(self, x: np.ndarray) -> np.ndarray:
        a, b = self.halves(x)
        return a.argmin(1) * len(self.second) + b.argmin(1)

    def possible(self, x: np.ndarray) -> np.ndarray:
        """Which groups of cells could hold a neighbour of each row."""
        a, b = self.halves(x)
        low_a, low_b = least_distances(a, self.first, self.reach_first), least_distances(b, self.second, self.reach_second)
        cells = len(self.first) * len(self.second)
        step, parts = max(1, GRID_CELLS_AT_ONCE // cells), []
        for at in range(0, len(x), step):
            low = low_a[at : at + step, :, None] + low_b[at : at + step, None, :]
            held = low.reshape(len(low), -1) <= 2 - 2 * MIN_COSINE + SLACK
            parts.append(np.logical_or.reduceat(held, np.arange(0, cells, self.per_group), axis=1))
        return np.concatenate(parts)


def fit_grid(nodes: DataFrame, rows: int, labels: int) -> Grid | None:
    """Codebooks, and reaches over all nodes; None without nodes."""
    sample = nodes.orderBy(digest("node", "fit"), "node").limit(FIT_ROWS).select("vector").toPandas()["vector"]
    if not len(sample):
        return None
    x = unit(sample.tolist())
    cut = max(1, x.shape[1] // 2)
    k = min(MAX_CODEWORDS, max(2, math.ceil(math.sqrt(rows / (CELL_ROWS * max(labels, 1))))))
    first, second = along(lloyd(x[:, :cut], k)), along(lloyd(x[:, cut:], k))
    far = _reaches(nodes, Grid(first, second, np.zeros(len(first)), np.zeros(len(second)), 1))
    cells = len(first) * len(second)
    per_group = min(cells, max(1, round(BLOCK_ROWS * cells * max(labels, 1) / rows)))
    return Grid(first, second, far[: len(first)], far[len(first) :], per_group)


def _reaches(nodes: DataFrame, grid: Grid) -> np.ndarray:
    """Largest distance of any node to the codeword it is filed under, per codeword."""
    size = len(grid.first) + len(grid.second)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        far = np.zeros(size)
        for x in _units(batches):
            a, b = grid.halves(x)
            np.maximum.at(far, a.argmin(1), np.sqrt(a.min(1)))
            np.maximum.at(far, len(grid.first) + b.argmin(1), np.sqrt(b.min(1)))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(far)], ["word", "far"])

    rows = nodes.select("vector").mapInArrow(work, "word bigint, far double").groupBy("word").agg(F.max("far").alias("far")).collect()
    out = np.zeros(size)
    for r in rows:
        out[r["word"]] = r["far"]
    return out


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            yield unit(batch.slice(at, 1024).column(0).to_pylist())


def visit_cells(nodes: DataFrame, grid: Grid) -> DataFrame:
    """(label, cell, own, node, vector): each node in its own group of cells and in those it visits."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                x = unit(part.column(2).to_pylist())
                home, chosen = grid.own(x) // grid.per_group, grid.possible(x)
                # Either of two groups sees the other's members as possible, so one of them visits, by turns.
                here, there = home[:, None], np.arange(chosen.shape[1])[None, :]
                chosen &= np.where((here + there) % 2 == 0, here <= there, here > there)
                row, group = np.nonzero(chosen)
                own_row = np.arange(len(x))
                rows = np.r_[own_row, row]
                cells = np.r_[home, group]
                own = np.r_[np.ones(len(x), bool), np.zeros(len(row), bool)]
                for a in range(0, len(rows), 8192):
                    taken = part.take(pa.array(rows[a : a + 8192]))
                    yield pa.RecordBatch.from_arrays(
                        [taken.column(1), pa.array(cells[a : a + 8192]), pa.array(own[a : a + 8192]), taken.column(0), taken.column(2)],
                        ["label", "cell", "own", "node", "vector"],
                    )

    return nodes.select("node", "label", "vector").mapInArrow(
        work, "label string, cell bigint, own boolean, node string, vector array<double>"
    )


def verified_links(visits: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """(a, b), a < b: pairs that meet in a cell with the cosine wanted."""
    sizes = visits.filter("own").groupBy("label", "cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
    large = settle(sizes.filter("blocks > 1"), "vector-cells")
    marked = lookup_join(visits, large, ["label", "cell"], ["node"]).withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    block = F.when(F.col("own"), F.array(F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))).otherwise(
        F.sequence(F.lit(0), F.col("blocks") - 1)
    )
    placed = marked.select("label", "cell", "own", "node", "vector", F.explode(block).alias("block"))
    named = placed.select(F.concat_ws("|", "label", "cell", "block").alias("at"), "own", "node", "vector")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, names, held = None, [], []
        matrix = None
        for whole in batches:
            for start in range(0, whole.num_rows, 4096):
                batch = whole.slice(start, 4096)
                keys = np.array(batch.column(0).to_pylist(), object)
                first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
                out: list[np.ndarray] = []
                for a, b in zip(first, np.r_[first[1:], len(keys)]):
                    if keys[a] != key:
                        key, names, held, matrix = keys[a], [], [], None
                    part = batch.slice(int(a), int(b - a))
                    n_own = int(np.count_nonzero(part.column(1).to_numpy(zero_copy_only=False)))
                    if n_own:
                        names += part.column(2).slice(0, n_own).to_pylist()
                        held.append(unit(part.column(3).slice(0, n_own).to_pylist()))
                    if n_own == b - a or not names:
                        continue
                    if matrix is None or len(matrix) < len(names):
                        matrix, labels = np.concatenate(held), np.array(names)
                    visitors = np.array(part.column(2).slice(n_own).to_pylist())
                    met = unit(part.column(3).slice(n_own).to_pylist()) @ matrix.T >= min_cosine
                    q, r = np.nonzero(met)
                    left, right = visitors[q], labels[r]
                    other = left != right
                    out.append(np.stack([np.where(left < right, left, right)[other], np.where(left < right, right, left)[other]]))
                if out:
                    pairs = np.concatenate(out, axis=1)
                    if pairs.shape[1]:
                        yield pa.RecordBatch.from_arrays([pa.array(pairs[0].tolist(), pa.string()), pa.array(pairs[1].tolist(), pa.string())], ["a", "b"])

    # Members come before visitors, so a task holds one block of members at a time.
    ordered = named.repartition("at").sortWithinPartitions("at", F.desc("own"))
    return ordered.mapInArrow(work, "a string, b string").distinct()


def near_vectors(table: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept): a row per row of `table`."""
    v, own = F.col(f"`{vector}`"), F.col(f"`{label}`")
    named = stored(
        table.select(
            F.col(f"`{key}`").alias("vec_id"),
            F.when(usable(v, own), node_name(v, own)).alias("node"),
            own.cast("string").alias("label"),
            v.cast("array<double>").alias("vector"),
        ),
        "vectors",
    )
    nodes = stored(
        named.filter("node IS NOT NULL").groupBy("node").agg(
            F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("vector").alias("vector")
        ),
        "vector-nodes",
    )
    size = nodes.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("label").alias("labels"), F.collect_set(F.size("vector")).alias("widths")).first()
    if len(size["widths"]) > 1:
        # Few kinds of vectors share a table; each is searched by itself, and what is none of them links with nothing.
        width = F.coalesce(F.size(v), F.lit(-1))
        parts = [near_vectors(table.filter(width == w), key, vector, label) for w in sorted(size["widths"])]
        rest = near_vectors(table.filter(~width.isin(size["widths"])), key, vector, label)
        return reduce(DataFrame.unionByName, parts, rest)
    grid = fit_grid(nodes, size["n"], size["labels"])
    rows = named.select("vec_id", "node")
    if grid is None:
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    links = stored(verified_links(stored(visit_cells(nodes, grid), "vector-visits")), "vector-links")
    plain = nodes.select("node", "first", "copies")
    both = links.union(links.select("b", "a"))
    others = plain.select(F.col("node").alias("b"), "copies")
    linked = both.join(others, "b").groupBy("a").agg(F.sum("copies").alias("linked")).withColumnRenamed("a", "node")
    rooted = plain.join(connected_components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    facts = rooted.join(lowest, "root").join(linked, "node", "left").select(
        "node", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).cast("bigint").alias("n_links"), "component_id"
    )
    found = lookup_join(rows, stored(facts, "vector-facts"), ["node"], ["vec_id"])
    component = F.coalesce("component_id", "vec_id")
    return found.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
