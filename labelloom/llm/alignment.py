"""Alignment of two tokenizers' tokens by products of sparse incidence matrices.

Over the bytes of space + text, a tokenizer is an incidence matrix of tokens by bytes, kept in
compressed sparse rows. Gustavson's row products A * B^T merge, for the bytes of a token of A, the rows of
B^T, and give the links: token occurrences that share bytes, with the number of shared bytes. Byte
offsets at which tokens of both end cut the tokens into groups; the product of token-by-group
incidences gives the links within groups (its rows are sized by the symbolic phase alone where only
their number is asked for, since a group can hold many tokens on both sides).

Products run over pieces of about CHUNK_BYTES bytes that end at a group's end, so memory is bounded whatever a
text's length. How many documents hold an id pair linked is counted over the corpus in one combined
aggregate and looked up for each document's pairs; a document's texts and tokens never leave its task.

Null and empty texts, and texts whose joined token bytes differ from space + text in either vocabulary,
have no tokens: zeros and an empty digest. Rows with equal or no ids are documents of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelloom.llm.common import stored
from labelloom.llm.tokens import TokenBytes, byte_tokenizer, piece_tokenizer
from labelloom.plans.joins import lookup_join
from labelloom.plans.shared import fresh_path, settle

SLICE_BYTES = 500_000
CHUNK_BYTES = 1_000_000
# A task numbers its rows from its own multiple of this.
TASK_ROWS = 2**33
PAIR = 2**32


@dataclass(frozen=True)
class Csr:
    """Compressed sparse rows: row i has columns indices[indptr[i]:indptr[i + 1]] with these values."""

    indptr: np.ndarray
    indices: np.ndarray
    values: np.ndarray
    columns: int

    @property
    def rows(self) -> int:
        return len(self.indptr) - 1

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.indptr))

    def transposed(self) -> Csr:
        order = np.argsort(self.indices, kind="stable")
        ends = np.cumsum(np.bincount(self.indices, minlength=self.columns))
        return Csr(np.r_[0, ends], self.row_of()[order], self.values[order], self.rows)

    def product_sizes(self, other: Csr) -> np.ndarray:
        """Products that each row of self * other merges (the symbolic phase's upper bound, exact if they differ in column)."""
        each = np.r_[0, np.cumsum(np.diff(other.indptr)[self.indices])]
        return each[self.indptr[1:]] - each[self.indptr[:-1]]

    def product(self, other: Csr) -> Csr:
        """self * other: row i merges the rows k of other, for each k in row i of self."""
        sizes = np.diff(other.indptr)[self.indices]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(other.indptr[self.indices] - (ends - sizes), sizes)
        columns, values = other.indices[at], np.repeat(self.values, sizes) * other.values[at]
        row = np.repeat(self.row_of(), sizes)
        place = row * np.int64(max(other.columns, 1)) + columns
        if total and (place[1:] < place[:-1]).any():
            order = np.argsort(place, kind="stable")
            place, row, columns, values = place[order], row[order], columns[order], values[order]
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]]) if total else np.array([], np.int64)
        merged = np.add.reduceat(values, first) if total else values
        indptr = np.r_[0, np.cumsum(np.bincount(row[first], minlength=self.rows))]
        return Csr(indptr, columns[first], merged, other.columns)


def byte_incidence(ends: np.ndarray, start: int) -> Csr:
    """Tokens by bytes, for consecutive tokens that end at `ends`."""
    size = int(ends[-1] - start) if len(ends) else 0
    return Csr(np.r_[0, ends - start], np.arange(size), np.ones(size, np.int64), size)


def group_incidence(groups: np.ndarray, count: int) -> Csr:
    """Tokens by groups: each token is in one."""
    return Csr(np.arange(len(groups) + 1), groups, np.ones(len(groups), np.int64), count)


class Pair:
    """Two tokenizers, the bytes of their tokens, and how to write their ids in a group list."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = byte_tokenizer(path_a, True), piece_tokenizer(path_b)
        self.bytes_a, self.bytes_b = TokenBytes(self.a.token_bytes()), TokenBytes(self.b.token_bytes())
        self.written = [f"{i}{sep}" for i in range(max(self.bytes_a.size, self.bytes_b.size)) for sep in ",|;"]

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of both for each text; None for texts without tokens."""
        given = [i for i, t in enumerate(texts) if t]
        out: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(texts)
        for i, b in zip(given, self.b.ids([texts[i] for i in given])):
            spaced = " " + texts[i]
            raw, a = spaced.encode("utf-8", "surrogatepass"), self.a.ids(spaced)
            sizes = int(self.bytes_a.lengths[a].sum()), int(self.bytes_b.lengths[b].sum())
            if sizes == (len(raw), len(raw)) and self.bytes_a.spell(a) == raw and self.bytes_b.spell(b) == raw:
                out[i] = a, b
        return out


class Aligned:
    """Documents side by side in one byte stream: token ends, groups, and which document each token is in."""

    def __init__(self, pair: Pair, found: list[tuple[np.ndarray, np.ndarray] | None]):
        docs = [x if x is not None else (np.array([], np.uint32),) * 2 for x in found]
        self.a, self.b = (np.concatenate([np.array([], np.uint32), *(d[s] for d in docs)]).astype(np.int64) for s in (0, 1))
        self.n_a, self.n_b = (np.array([len(d[s]) for d in docs], np.int64) for s in (0, 1))
        self.doc_a = np.repeat(np.arange(len(docs)), self.n_a)
        self.end_a, self.end_b = np.cumsum(pair.bytes_a.lengths[self.a]), np.cumsum(pair.bytes_b.lengths[self.b])
        self.last_a, self.last_b = _in(self.end_a, self.end_b), _in(self.end_b, self.end_a)
        self.group_a, self.group_b = (np.cumsum(x) - x for x in (self.last_a, self.last_b))
        self.groups = int(self.last_a.sum())

    def pieces(self, size: int) -> Iterator[tuple[int, int, int, int, int]]:
        """(first A token, end, first B token, end, first byte) of runs of whole groups with about `size` bytes."""
        ends = self.end_a[self.last_a]
        if not len(ends):
            return
        cuts = np.r_[np.flatnonzero(ends[1:] // size != ends[:-1] // size), len(ends) - 1]
        to_a, to_b = (np.flatnonzero(x)[cuts] + 1 for x in (self.last_a, self.last_b))
        yield from zip(np.r_[0, to_a[:-1]], to_a, np.r_[0, to_b[:-1]], to_b, np.r_[0, ends[cuts[:-1]]])

    def overlaps(self, size: int = CHUNK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(A token, B token, shared bytes) of all links, piece by piece."""
        for a0, a1, b0, b1, x in self.pieces(size):
            links = byte_incidence(self.end_a[a0:a1], x).product(byte_incidence(self.end_b[b0:b1], x).transposed())
            yield links.row_of() + a0, links.indices + b0, links.values

    def group_links(self, rows: int = 4096) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(A token, B token) of all links within groups, for runs of A tokens."""
        right = group_incidence(self.group_b, self.groups).transposed()
        for at in range(0, len(self.a), rows):
            links = group_incidence(self.group_a[at : at + rows], self.groups).product(right)
            yield links.row_of() + at, links.indices

    def group_link_counts(self) -> np.ndarray:
        """Links within its group of each A token, without making them."""
        return group_incidence(self.group_a, self.groups).product_sizes(group_incidence(self.group_b, self.groups).transposed())

    def group_lists(self, pair: Pair) -> list[str]:
        """Per document `a1,a2|b1;a3|b2,b3`: ids of both, group by group."""
        tokens_a, tokens_b = (np.bincount(g, minlength=self.groups) for g in (self.group_a, self.group_b))
        code = np.empty(len(self.a) + len(self.b), np.int64)
        code[np.arange(len(self.a)) + (np.cumsum(tokens_b) - tokens_b)[self.group_a]] = 3 * self.a + self.last_a
        code[np.arange(len(self.b)) + np.cumsum(tokens_a)[self.group_b]] = 3 * self.b + 2 * self.last_b
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return ["".join(map(pair.written.__getitem__, code[s:e].tolist()))[:-1] for s, e in zip([0, *ends], ends)]

    def by_doc(self, per_token: np.ndarray) -> np.ndarray:
        return np.bincount(self.doc_a, per_token, minlength=len(self.n_a)).astype(np.int64)


def _in(values: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Which of the ascending `values` are among the ascending `others`."""
    if not len(others):
        return np.zeros(len(values), bool)
    return others[np.minimum(np.searchsorted(others, values), len(others) - 1)] == values


def _text_slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about SLICE_BYTES of text (a longer text stands alone)."""
    sizes = np.array(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
    part = (np.cumsum(sizes) - sizes) // SLICE_BYTES
    edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(sizes) else np.array([], int)
    for a, b in zip(edges, np.r_[edges[1:], len(sizes)]):
        yield batch.slice(int(a), int(b - a))


def align_documents(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, n_group_links, groups_sha256, pairs, times): a row per document.

    `pairs` has its different linked id pairs (A's id times 2^32 plus B's), `times` the links of each.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, row = Pair(path_a, path_b), TaskContext.get().partitionId() * TASK_ROWS
        for batch in batches:
            for part in _text_slices(batch, 1):
                found = pair.encode(part.column(1).to_pylist())
                it, n = Aligned(pair, found), part.num_rows
                made = [(it.doc_a[a], it.a[a] * PAIR + it.b[b]) for a, b, _ in it.overlaps()]
                doc = np.concatenate([np.array([], np.int64), *(d for d, _ in made)])
                code = np.concatenate([np.array([], np.int64), *(c for _, c in made)])
                links = np.bincount(doc, minlength=n)
                order = np.lexsort((code, doc))
                doc, code = doc[order], code[order]
                first = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])]) if len(doc) else np.array([], np.int64)
                offsets = pa.array(np.r_[0, np.cumsum(np.bincount(doc[first], minlength=n))], pa.int32())
                digests = ["" if f is None else hashlib.sha256(s.encode()).hexdigest() for f, s in zip(found, it.group_lists(pair))]
                columns = [np.arange(row, row + n), part.column(0), it.n_a, it.n_b, it.by_doc(it.last_a), links, it.by_doc(it.group_link_counts()), digests]
                lists = [
                    pa.ListArray.from_arrays(offsets, pa.array(code[first])),
                    pa.ListArray.from_arrays(offsets, pa.array(np.diff(np.r_[first, len(doc)]), pa.int32())),
                ]
                row += n
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns] + lists, names)

    names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_group_links", "groups_sha256", "pairs", "times"]
    narrow = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return narrow.mapInArrow(
        work,
        "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_group_links bigint, "
        "groups_sha256 string, pairs array<bigint>, times array<int>",
    )


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, documents, best): how many documents hold an id pair linked, and whether none of A's id has more.

    An id of A has at most as many pairs as B has ids, which bounds the window.
    """
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("documents"))
    same = Window.partitionBy(F.expr("shiftright(pair, 32)"))
    return counts.select("pair", "documents", (F.col("documents") == F.max("documents").over(same)).alias("best"))


def align_tokens(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_group_links): a row per document."""
    path = fresh_path(docs.sparkSession, "alignment")
    made = align_documents(docs, path_a, path_b, key, text)
    # Sorted numbers: worth the stronger compression.
    made.write.option("compression", "zstd").parquet(path)
    aligned = docs.sparkSession.read.schema(made.schema).parquet(path)
    counts = settle(pair_counts(aligned), "alignment-counts")
    held = aligned.select("row", "times", F.posexplode("pairs").alias("at", "pair")).select("row", "pair", F.get("times", F.col("at")).alias("n"))
    scored = lookup_join(held, counts, ["pair"], ["row"]).groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).cast("bigint").alias("n_best"),
        F.sum(F.col("n") * F.col("documents")).cast("bigint").alias("count_sum"),
    )
    whole = aligned.drop("pairs", "times").join(stored(scored, "alignment-scores"), "row", "left")
    zero = F.lit(0).cast("bigint")
    return whole.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256", "n_group_links",
    )


def token_links(docs: DataFrame, path_a: str, path_b: str, key: str = "doc_id", text: str = "text", within_groups: bool = False) -> DataFrame:
    """(row, doc_id, a_at, b_at, a_id, b_id, shared_bytes): a row per link; `row` tells rows of equal id apart.

    Token places count from 0 within the document. `within_groups` gives all links of a group, with null bytes.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, row = Pair(path_a, path_b), TaskContext.get().partitionId() * TASK_ROWS
        for batch in batches:
            for part in _text_slices(batch, 1):
                it = Aligned(pair, pair.encode(part.column(1).to_pylist()))
                from_a, from_b = np.cumsum(it.n_a) - it.n_a, np.cumsum(it.n_b) - it.n_b
                for a, b, *shared in it.group_links() if within_groups else it.overlaps():
                    doc = it.doc_a[a]
                    bytes_ = pa.array(shared[0], pa.int64()) if shared else pa.nulls(len(a), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc + row), part.column(0).take(pa.array(doc)), pa.array(a - from_a[doc]), pa.array(b - from_b[doc]), pa.array(it.a[a]), pa.array(it.b[b]), bytes_],
                        names,
                    )
                row += part.num_rows

    names = ["row", "doc_id", "a_at", "b_at", "a_id", "b_id", "shared_bytes"]
    narrow = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return narrow.mapInArrow(work, ", ".join(f"{n} bigint" for n in names))
