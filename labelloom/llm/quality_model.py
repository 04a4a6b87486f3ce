"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature is cut into bins and has a lookup table of additive scores; a few pairs of
features have a table each as well. Tables are learned by cyclic boosting: in turn,
every feature gets one small step of a shallow tree fitted to the current residuals of
its bins. Pairs are chosen by how much a single cut on both axes would still explain, and
boosted the same way. A score is the logistic of the sum of one table entry per
feature and pair, added up for whole batches.

Features are counted from the text alone. The model is fitted on at most
`MAX_ROWS` labelled rows (a seeded sample, by digest), so its cost and memory are fixed; scoring covers
every row, in place, without a shuffle.

Null texts score as empty ones. Rows with a null label, or a label that is neither 0 nor 1,
are not learned from; with labels of one kind only, the score is that kind's share. Repeated rows are scored alike; scores are joined
to nothing, and rows keep all their columns, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.functions.hashing import digest

MAX_ROWS = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 8
ROUNDS = 250
PAIR_ROUNDS = 150
RATE = 0.08
LEAVES = 4
MIN_CHILD = 4.0
RIDGE = 2.0

SIGNS = b"#*$%&|<>"
FEATURES = (
    "log_words", "mean_word", "long_words", "short_words", "upper_words", "title_words", "digits", "marks_hash",
    "marks_money", "marks_angle", "bars", "shouts", "stops", "commas", "distinct", "top_word", "repeat_lines",
    "repeat_windows", "words_a_line", "longest_word", "other_script", "inner_signs",
)
LINE_PARTS = re.compile(rb"\n+")


def features(text: str) -> list[float]:
    """The values of FEATURES for one text; all of it is read."""
    raw = text.encode("utf-8", "surrogatepass")
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    lengths = np.fromiter(map(len, words), np.int32, n)
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [x for x in LINE_PARTS.split(raw) if x.strip()]
    windows = n - 2
    repeated = 1 - len(set(zip(words, words[1:], words[2:]))) / windows if windows > 0 else 0.0
    per_word = 1.0 / n
    return [
        float(np.log1p(n)),
        float(lengths.mean()),
        float((lengths > 12).mean()),
        float((lengths <= 3).mean()),
        sum(map(str.isupper, words)) * per_word,
        sum(map(str.istitle, words)) * per_word,
        (len(raw) - len(raw.translate(None, b"0123456789"))) * per_word,
        (raw.count(b"#") + raw.count(b"*")) * per_word,
        (raw.count(b"$") + raw.count(b"%") + raw.count(b"&")) * per_word,
        (raw.count(b"<") + raw.count(b">")) * per_word,
        raw.count(b"|") * per_word,
        raw.count(b"!") * per_word,
        raw.count(b".") * per_word,
        raw.count(b",") * per_word,
        len(counts) * per_word,
        max(counts.values()) * per_word,
        1 - len(set(lines)) / len(lines),
        repeated,
        n / len(lines),
        float(lengths.max()),
        (len(raw) - len(text)) * per_word,
        (len(raw) - len(raw.translate(None, b"/\\@_=+{}[]~^"))) * per_word,
    ]


@dataclass
class Model:
    """Bin edges and additive tables."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)
    intercept: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for the rows of `x`."""
        total = np.full(len(x), self.intercept)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, j], "right")]
        for (i, j), table in zip(self.pairs, self.pair_tables):
            a = np.searchsorted(self.pair_edges[i], x[:, i], "right")
            total += table[a, np.searchsorted(self.pair_edges[j], x[:, j], "right")]
        return 1 / (1 + np.exp(-total))


def bin_edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1], method="inverted_cdf"))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def tree_step(g: np.ndarray, h: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """Values per bin of a tree with at most `leaves` leaves over ordered bins, from gradient and weight sums."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = (1e-9, None, None)
        for p, (a, b) in enumerate(parts):
            if b - a < 2:
                continue
            lg, lh = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
            rg, rh = g[a:b].sum() - lg, h[a:b].sum() - lh
            gain = _gain(lg, lh) + _gain(rg, rh) - _gain(lg + rg, lh + rh)
            gain[(lh < MIN_CHILD * 0.05) | (rh < MIN_CHILD * 0.05)] = 0
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), p, a + k + 1)
        if best[1] is None:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def cross_step(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree with one cut on each axis of a grid of sums."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    all_g, all_h = cg[-1, -1], ch[-1, -1]
    a_g, a_h = cg[:-1, :-1], ch[:-1, :-1]
    row_g, row_h, column_g, column_h = cg[:-1, -1:], ch[:-1, -1:], cg[-1:, :-1], ch[-1:, :-1]
    quarters = [
        (a_g, a_h), (row_g - a_g, row_h - a_h), (column_g - a_g, column_h - a_h),
        (all_g - row_g - column_g + a_g, all_h - row_h - column_h + a_h),
    ]
    if not a_g.size:
        return 0.0, np.zeros_like(g)
    gain = sum(_gain(x, np.maximum(y, 0)) for x, y in quarters) - _gain(all_g, all_h)
    r, c = np.unravel_index(int(gain.argmax()), gain.shape)
    out = np.empty_like(g)
    for (x, y), rows, columns in zip(
        quarters,
        (slice(None, r + 1), slice(None, r + 1), slice(r + 1, None), slice(r + 1, None)),
        (slice(None, c + 1), slice(c + 1, None), slice(None, c + 1), slice(c + 1, None)),
    ):
        out[rows, columns] = x[r, c] / (max(y[r, c], 0) + RIDGE)
    return float(gain[r, c]), out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting of the main tables, then of the chosen pairs."""
    rows, width = x.shape
    edges = [bin_edges(x[:, j], BINS) if rows else np.zeros(0) for j in range(width)]
    model = Model(edges, [np.zeros(len(e) + 1) for e in edges])
    share = float(np.clip(y.mean() if rows else 0.5, 0.001, 0.999))
    model.intercept = float(np.log(share / (1 - share)))
    if not rows or y.min() == y.max():
        return model
    bins = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)]
    total = np.full(rows, model.intercept)
    for _ in range(ROUNDS):
        for j in range(width):
            p = 1 / (1 + np.exp(-total))
            size = len(model.tables[j])
            step = RATE * tree_step(np.bincount(bins[j], y - p, size), np.bincount(bins[j], p * (1 - p), size))
            model.tables[j] += step
            total += step[bins[j]]
    model.pair_edges = [bin_edges(x[:, j], PAIR_BINS) for j in range(width)]
    coarse = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.pair_edges)]
    sizes = [len(e) + 1 for e in model.pair_edges]

    def sums(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        cell, size = coarse[i] * sizes[j] + coarse[j], sizes[i] * sizes[j]
        shape = (sizes[i], sizes[j])
        return np.bincount(cell, y - p, size).reshape(shape), np.bincount(cell, p * (1 - p), size).reshape(shape)

    ranked = sorted(((cross_step(*sums(i, j))[0], i, j) for i in range(width) for j in range(i)), reverse=True)
    model.pairs = [(i, j) for gain, i, j in ranked[:PAIRS] if gain > 0]
    model.pair_tables = [np.zeros((sizes[i], sizes[j])) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in zip(model.pairs, model.pair_tables):
            step = RATE * cross_step(*sums(i, j))[1]
            table += step
            total += step[coarse[i], coarse[j]]
    return model


def sample_features(docs: DataFrame, labelled: DataFrame, key: str = "doc_id", text: str = "text", max_rows: int = MAX_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most `max_rows` rows of `labelled(key, quality)`, chosen by digest."""
    wanted = labelled.filter(F.col("quality").isin(0, 1) & F.col("key").isNotNull())
    wanted = wanted.groupBy("key").agg(F.max("quality").alias("quality"))
    few = wanted.orderBy(digest("key", "quality"), "key").limit(max_rows)
    # `few` holds max_rows rows of two numbers at most.
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).join(F.broadcast(few), "key")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [features(t.as_py() or "") for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.list_(pa.float64())), batch.column(1)], ["x", "y"])

    # Rows that share a key are all taken from `docs`, so the sample is cut again before it is gathered.
    found = rows.select("text", F.col("quality").cast("int")).mapInArrow(work, "x array<double>, y int").limit(max_rows).toPandas()
    if not len(found):
        return np.zeros((0, len(FEATURES))), np.zeros(0)
    x, y = np.array(found["x"].tolist(), float), found["y"].to_numpy(float)
    order = np.lexsort((*x.T, y))  # the fit must not depend on the order of arrival
    return x[order], y[order]


def score_documents(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) in place."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([features(t.as_py() or "") for t in batch.column(1)], float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(values))], ["key", "score"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")).mapInArrow(work, f"key {kind}, score double")


def filter_quality(docs: DataFrame, model: Model, threshold: float, text: str = "text") -> DataFrame:
    """The rows of `docs` that score `threshold` or more, all columns, in place."""
    schema, at = docs.schema, docs.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([features(t.as_py() or "") for t in batch.column(at)], float).reshape(-1, len(FEATURES))
            yield batch.filter(pa.array(model.score(values) >= threshold))

    return docs.mapInArrow(work, schema)
