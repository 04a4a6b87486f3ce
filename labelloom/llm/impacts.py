"""Ranked lexical search over impact vectors in buckets of similar length.

A document is a sparse vector over the terms that queries ask for: a term's impact is its weight times the
document's saturated term frequency, a whole number. A query is the sum of its terms' coordinates, so a
score is an inner product, and its largest k are wanted.

Vectors lie in the shared folder in the order of their length, longest first, and are read in buckets. Against the
k-th best score known so far, a bucket is passed over where the length of its first vector leaves no such score (by
Cauchy and Schwarz; then all later ones of the task are, too), or where the largest coordinate of each term in the
bucket does. Inside, the terms are split: those whose largest coordinates sum to less than the score wanted
cannot lift a vector alone, so only vectors with one of the other terms are looked at, and each is bounded by its sum over these
and the lesser of both bounds for the rest. What survives is scored exactly in integers. Bounds are rounded up, and ties are kept, so nothing
is lost.

The longest vectors are searched first and give every query a score to start from; all others follow in
parallel, each task keeping k rows a query.

Queries come in blocks of about `BLOCK_BYTES` of text, which go to the tasks; documents never leave theirs as texts, only
as vectors over the block's terms. Null texts and texts without a term take no part, nor do items without one. Rows
of equal or no id are documents, or items, of their own; null ids come last among equal scores.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelloom.llm.common import stored
from labelloom.plans.shared import settle

K = 10
BLOCK_BYTES = 8 * 1024 * 1024
BUCKET_ROWS = 1024
# A plan choice: rows are searched first until about so many are; results do not depend on it.
FIRST_ROWS = 20_000
FILE_ROWS = 16_384
MANY_FILES = 4096
NULL_ID = np.iinfo(np.int64).max

# Of the signs below 128, letters (made small) and digits are kept; all others part terms.
SIGNS = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in bytes(range(128)).lower() + bytes(range(128, 256)))


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and all signs beyond, with A-Z made small."""
    return (text or "").encode("utf-8", "surrogatepass").translate(SIGNS).split()


@dataclass(frozen=True)
class Block:
    """Queries of a block: their number, id and terms (as places in `vocabulary`)."""

    numbers: list[int]
    ids: list[int | None]
    terms: list[np.ndarray]
    vocabulary: dict[bytes, int]


def read_block(items: DataFrame) -> Block:
    rows = [(r["_item"], r["item_id"], sorted(set(terms_of(r["text"])))) for r in items.collect()]
    rows = [r for r in rows if r[2]]
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, _, terms in rows for t in terms}))}
    return Block([r[0] for r in rows], [r[1] for r in rows], [np.array([vocabulary[t] for t in r[2]], np.int64) for r in rows], vocabulary)


def count_terms(docs: DataFrame, vocabulary: dict[bytes, int], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, terms, tfs) of each document with a term: all its terms' number, and how often it has those asked for."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Texts are turned into words a slice at a time; a batch of texts is bounded by Spark.
            rows: list[tuple] = []
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = terms_of(value.as_py())
                if not words:
                    continue
                held = Counter(map(vocabulary.get, words))
                held.pop(None, None)
                found = sorted(held)
                rows.append((doc, len(words), found, [held[t] for t in found]))
            columns = list(zip(*rows)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["doc_id", "n", "terms", "tfs"])

    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]
    narrow = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return narrow.mapInArrow(work, "doc_id bigint, n bigint, terms array<int>, tfs array<bigint>")


def weights_of(documents: int, held: np.ndarray) -> np.ndarray:
    """Whole weights of terms that so many documents hold."""
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in held], np.int64)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the lists within their joined values, and the values."""
    offsets = column.offsets.to_numpy()
    return offsets[1:] - offsets[0], column.flatten().to_numpy(zero_copy_only=False)


def _by_list(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.r_[np.zeros(1, values.dtype), np.cumsum(values)]
    return total[ends] - total[np.r_[0, ends[:-1]]]


def impact_vectors(counted: DataFrame, documents: int, words: int, weights: np.ndarray) -> DataFrame:
    """(norm, doc_id, terms, impacts) of all documents that can score above 0."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, terms = _lists(batch.column(2))
            _, tf = _lists(batch.column(3))
            m = np.array([10 + 90 * n * documents // words for n in batch.column(1).to_pylist()], np.int64)
            each = np.repeat(m, np.diff(np.r_[0, ends]))
            impacts = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * each))
            norms = np.sqrt(_by_list(impacts.astype(np.float64) ** 2, ends))
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(impacts, pa.int64()))
            flat = pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(terms, pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(norms), batch.column(0), flat, lists], ["norm", "doc_id", "terms", "impacts"])

    made = counted.select("doc_id", "n", "terms", "tfs").filter(F.size("terms") > 0)
    return made.mapInArrow(work, "norm double, doc_id bigint, terms array<int>, impacts array<bigint>").filter("norm > 0")


class Bucket:
    """Vectors of similar length, by row and by term."""

    def __init__(self, norms: np.ndarray, ids: np.ndarray, ends: np.ndarray, terms: np.ndarray, impacts: np.ndarray, size: int):
        self.norms, self.ids, self.ends, self.terms, self.impacts = norms, ids, ends, terms.astype(np.int64), impacts
        self.starts = np.r_[0, ends[:-1]]
        order = np.argsort(self.terms, kind="stable")
        self.row = np.repeat(np.arange(len(ends)), ends - self.starts)[order]
        self.value = impacts[order]
        self.from_ = np.r_[0, np.cumsum(np.bincount(self.terms, minlength=size))]
        held = np.flatnonzero(np.diff(self.from_))
        self.largest = np.zeros(size, np.int64)
        if len(held):
            self.largest[held] = np.maximum.reduceat(self.value, self.from_[held])

    def candidates(self, query: np.ndarray, wanted: int) -> np.ndarray:
        """Rows that can score `wanted` or more."""
        tops = self.largest[query]
        order = np.argsort(-tops, kind="stable")
        after = np.cumsum(tops[order][::-1])[::-1]
        # Terms from here on cannot reach the score together, without one of the terms before.
        cut = int(np.searchsorted(-after, -wanted, "right"))
        if not cut:
            return np.array([], int)
        sums, squares = np.zeros(len(self.ids), np.int64), np.zeros(len(self.ids))
        for t in query[order[:cut]].tolist():
            at, value = self.row[self.from_[t] : self.from_[t + 1]], self.value[self.from_[t] : self.from_[t + 1]]
            sums[at] += value
            squares[at] += value.astype(np.float64) ** 2
        rest = float(after[cut]) if cut < len(order) else 0.0
        left = np.sqrt(np.maximum(self.norms**2 * (1 + 1e-9) - squares, 0) * (len(order) - cut))
        return np.flatnonzero((sums > 0) & (sums + np.minimum(rest, left * (1 + 1e-9)) + 1 >= wanted))

    def scores(self, rows: np.ndarray, asked: np.ndarray) -> np.ndarray:
        """Exact scores of rows; `asked` marks the query's terms."""
        sizes = (self.ends - self.starts)[rows]
        ends = np.cumsum(sizes)
        at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.starts[rows] - (ends - sizes), sizes)
        return _by_list(np.where(asked[self.terms[at]], self.impacts[at], 0), ends)


def search(vectors: DataFrame, block: Block, known: np.ndarray, k: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(item, doc_id, score): each task's best `k` rows a query; `known` has scores that k documents reach."""
    queries, size = block.terms, len(block.vocabulary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.maximum(known, 1)
        best = [(np.array([], np.int64), np.array([], np.int64)) for _ in queries]
        roots = np.sqrt([len(q) for q in queries])
        for batch in batches:
            for at in range(0, batch.num_rows, bucket_rows):
                part = batch.slice(at, bucket_rows)
                norms = part.column(0).to_numpy()
                active = np.flatnonzero(roots * norms.max() * (1 + 1e-9) + 1 >= wanted)
                if not len(active):
                    continue
                ends, terms = _lists(part.column(2))
                bucket = Bucket(norms, part.column(1).fill_null(NULL_ID).to_numpy(), ends, terms, _lists(part.column(3))[1], size)
                asked = np.zeros(size, bool)
                for j in active.tolist():
                    rows = bucket.candidates(queries[j], int(wanted[j]))
                    if not len(rows):
                        continue
                    asked[queries[j]] = True
                    exact = bucket.scores(rows, asked)
                    asked[queries[j]] = False
                    enough = exact >= wanted[j]
                    scores, ids = np.r_[best[j][0], exact[enough]], np.r_[best[j][1], bucket.ids[rows[enough]]]
                    order = np.lexsort((ids, -scores))[:k]
                    best[j] = scores[order], ids[order]
                    if len(order) == k:
                        wanted[j] = max(wanted[j], int(scores[order[-1]]))
        sizes = [len(s) for s, _ in best]
        items = np.repeat(np.arange(len(best)), sizes)
        ids = np.concatenate([i for _, i in best] or [np.array([], np.int64)])
        scores = np.concatenate([s for s, _ in best] or [np.array([], np.int64)])
        yield pa.RecordBatch.from_arrays([pa.array(items, pa.int64()), pa.array(ids, pa.int64(), mask=ids == NULL_ID), pa.array(scores, pa.int64())], ["item", "doc_id", "score"])

    return vectors.select("norm", "doc_id", "terms", "impacts").mapInArrow(work, "item bigint, doc_id bigint, score bigint")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _rank_block(docs: DataFrame, block: Block, k: int, key: str, text: str, bucket_rows: int) -> DataFrame:
    counted = stored(count_terms(docs, block.vocabulary, key, text), "impact-counts")
    size = counted.agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("words")).first()
    documents, words = int(size["n"]), int(size["words"] or 0)
    held = np.zeros(len(block.vocabulary), np.int64)
    # A row for each term of the block at most.
    for r in counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect():
        held[r["t"]] = r["n"]
    made = impact_vectors(counted, documents, words, weights_of(documents, held))
    # Small files for many tasks, until there are very many.
    parts = max(1, min(math.ceil(documents / FILE_ROWS), max(MANY_FILES, math.ceil(documents / 1_000_000))))
    longest_first = made.repartitionByRange(parts, F.desc("norm"), F.xxhash64("doc_id", "terms")).sortWithinPartitions(F.desc("norm"))
    vectors = stored(longest_first, "impact-vectors")
    known = np.zeros(len(block.ids), np.int64)
    cut = None
    if documents > FIRST_ROWS:
        cut = vectors.agg(F.percentile_approx("norm", 1 - FIRST_ROWS / documents, 10_000)).first()[0]
    if cut is None:
        found = search(vectors, block, known, k, bucket_rows)
    else:
        first = stored(_ranked(search(vectors.filter(F.col("norm") >= cut), block, known, k, bucket_rows), k), "impact-first")
        for r in first.filter(F.col("rank") == k).select("item", "score").collect():
            known[r["item"]] = r["score"]
        found = first.select("item", "doc_id", "score").unionByName(search(vectors.filter(F.col("norm") < cut), block, known, k, bucket_rows))
    names = docs.sparkSession.createDataFrame([(i, x) for i, x in enumerate(block.ids)], "item bigint, item_id bigint")
    # The queries of one block: bounded by its bytes.
    return _ranked(found, k).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def rank_documents(
    docs: DataFrame, items: DataFrame, k: int = K, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
    block_bytes: int = BLOCK_BYTES, bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the `k` best documents of each item, those with a score of 0 left out."""
    asked = settle(
        items.select(
            F.monotonically_increasing_id().alias("_item"), F.col(f"`{item_key}`").cast("bigint").alias("item_id"), F.col(f"`{item_text}`").alias("text")
        ).filter(F.col("text") != ""),
        "impact-items",
    )
    blocks = max(1, math.ceil(asked.nbytes / block_bytes))
    found = []
    for b in range(blocks):
        block = read_block(asked.df.filter(F.pmod(F.xxhash64("_item"), F.lit(blocks)) == b))
        if block.ids:
            found.append(_rank_block(docs, block, k, key, text, bucket_rows))
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.unionByName, found)
