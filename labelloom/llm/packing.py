"""Mixture-controlled packing of token streams into fixed windows.

Every source is a queue of documents. In each round a queue's credit grows by its target proportion of
a window (one sequence); what it has in whole quanta it sends, and the rest, its deficit, is carried to the
next round. So a small source speaks every few sequences, in runs of a quantum at least. When
a queue ends, it sends what is left, and the others share its part by their targets. Carried exactly, the
credit of source s at place p of the stream is floor(target of s * (p - tokens of ended queues) / targets of the
others) until its queue ends. So a token's round, and its place, follow from its place in its queue by integer
arithmetic, no state passes between tasks, and deficits cross partitions as they cross windows. Over any run
of whole rounds a source has its target to within a quantum and a token.

All documents are packed once. Without targets a source's target is its share of all tokens, so
the queues end together. Sequences are gapless; only the last of all can be short.

Steps: (1) tokens are made once and written with a running count per task and
source; (2) counts per (task, source) give each task's start in each queue;
(3) documents are cut into pieces in place, by whole columns. Token arrays are never shuffled.

Null texts are empty and consist of the end id alone. A null source is a queue of
its own. Repeated rows are separate documents.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Mapping
from fractions import Fraction
from math import lcm

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelloom.llm.common import stored
from labelloom.llm.tokens import byte_tokenizer
from labelloom.plans.joins import lookup_join
from labelloom.plans.shared import settle

SEQUENCE = 1024
QUANTUM = 128
END_ID = 0
SLICE_BYTES = 400_000
# Numbers held at once while rounds are looked up.
TABLE_CELLS = 500_000


class Schedule:
    """Tokens that each queue has spent at each place of the stream, in integers.

    Queues end in the order of size / weight. With k of them ended, which held `done[k]` tokens, a token
    goes to queue i of the others in the proportion weights[i] / `active[k]`.
    """

    def __init__(self, sizes: list[int], weights: list[int]):
        self.sizes, self.weights, self.total = sizes, weights, sum(sizes)
        order = sorted(range(len(sizes)), key=lambda i: Fraction(sizes[i], weights[i]))
        self.turn = {i: k for k, i in enumerate(order)}
        self.order, self.done, self.active, self.ends = order, [0], [sum(weights)], []
        for i in order:
            # The first place at which queue i is spent.
            self.ends.append(self.done[-1] - -sizes[i] * self.active[-1] // weights[i])
            self.done.append(self.done[-1] + sizes[i])
            self.active.append(self.active[-1] - weights[i])
        self.limits: dict[int, list[int]] = {}
        self.columns = {n: np.array(v, np.int64) for n, v in (("sizes", sizes), ("weights", weights), ("ends", self.ends), ("done", self.done), ("active", self.active))}
        self.turns = np.array([self.turn[i] for i in range(len(sizes))], np.int64)

    def spent(self, place: int) -> list[int]:
        """Tokens of each queue up to a place."""
        k = bisect_right(self.ends, place)
        done, active = self.done[k], self.active[k]
        return [n if self.turn[i] < k else w * (place - done) // active for i, (n, w) in enumerate(zip(self.sizes, self.weights))]

    def place_of(self, i: int, at: int) -> int:
        """The first place up to which queue i has spent token `at`."""
        if i not in self.limits:
            # How much queue i has spent when each queue ends.
            self.limits[i] = [self.weights[i] * self.sizes[j] // self.weights[j] for j in self.order]
        k = bisect_left(self.limits[i], at + 1)
        return self.done[k] - -(at + 1) * self.active[k] // self.weights[i]

    def sent(self, places: np.ndarray, quantum: int) -> np.ndarray:
        """Tokens that each queue has sent, in whole quanta until it ends, up to each place (a row for each)."""
        c = self.columns
        k = np.searchsorted(c["ends"], places, "right")
        credit = mul_div(c["weights"][None, :], (places - c["done"][k])[:, None], np.maximum(c["active"][k], 1)[:, None])
        return np.where(self.turns[None, :] < k[:, None], c["sizes"][None, :], credit // quantum * quantum)

    def places_of(self, i: int, at: np.ndarray) -> np.ndarray:
        """`place_of` for many tokens of a queue."""
        self.place_of(i, 0)
        c = self.columns
        k = np.searchsorted(np.array(self.limits[i], np.int64), at + 1, "left")
        return c["done"][k] - mul_div(-(at + 1), c["active"][k], c["weights"][i])


def mul_div(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """floor(a * b / c) of whole numbers whose product may be beyond 64 bits; the quotient is below 2^50 and c below 2^60.

    The quotient in doubles is a few units off at most, and what it leaves is exact modulo 2^64.
    """
    a, b, c = np.broadcast_arrays(np.asarray(a, np.int64), b, c)
    near = np.floor(a.astype(np.float64) * b / c).astype(np.int64)
    with np.errstate(over="ignore"):
        return near + (a * b - near * c) // c


def weights_of(sources: list[tuple[str | None, int]], targets: Mapping[str | None, float] | None) -> list[int]:
    """Whole numbers in the proportion of the sources' targets; their tokens without targets."""
    if targets is None:
        return [n for _, n in sources]
    wrong = [s for s, _ in sources if not targets.get(s, 0) > 0 or targets[s] == float("inf")]
    if wrong:
        raise ValueError(f"sources without a target above 0: {wrong}")
    parts = [Fraction(targets[s]) for s, _ in sources]
    scale = lcm(*(f.denominator for f in parts))
    whole = [int(f * scale) for f in parts]
    # Targets are held to one part in 2^50.
    excess = max(0, sum(whole).bit_length() - 50)
    return [max(1, w >> excess) for w in whole]


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about SLICE_BYTES in a column (a longer value stands alone)."""
    sizes = np.array(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64)
    part = (np.cumsum(sizes) - sizes) // SLICE_BYTES
    edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(sizes) else np.array([], int)
    for a, b in zip(edges, np.r_[edges[1:], len(sizes)]):
        yield batch.slice(int(a), int(b - a))


def tokenized(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, task, start, n, ids): `start` counts the task's earlier tokens of that source."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, task = byte_tokenizer(path), TaskContext.get().partitionId()
        end = np.array([END_ID], "<u4").tobytes()
        seen: dict[str | None, int] = {}
        for batch in batches:
            for part in _slices(batch, 1):
                ids = [x.tobytes() + end for x in tokenizer.batch([t or "" for t in part.column(1).to_pylist()])]
                sizes, starts = [len(x) // 4 for x in ids], []
                for s, n in zip(part.column(2).to_pylist(), sizes):
                    starts.append(seen.get(s, 0))
                    seen[s] = starts[-1] + n
                made = [part.column(0), part.column(2), pa.repeat(pa.scalar(task, pa.int32()), len(ids)), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(made, names)

    names = ["doc_id", "source", "task", "start", "n", "ids"]
    narrow = docs.select(
        F.col(f"`{key}`").cast("bigint"), F.col(f"`{text}`"), F.col(f"`{source}`").cast("string")
    )
    return narrow.mapInArrow(work, "doc_id bigint, source string, task int, start bigint, n bigint, ids binary")


class Cutter:
    """Cuts documents into the pieces that a schedule gives them."""

    def __init__(self, schedule: Schedule, length: int, window: int, quantum: int):
        self.schedule, self.length, self.window, self.quantum = schedule, length, window, quantum

    def places(self, queue: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Places in the whole stream of tokens `at` of queues."""
        plan, out = self.schedule, np.empty(len(at), np.int64)
        due = np.minimum(plan.columns["sizes"][queue], (at // self.quantum + 1) * self.quantum) - 1
        rounds = np.empty(len(at), np.int64)
        for i in np.unique(queue).tolist():
            mine = queue == i
            rounds[mine] = (plan.places_of(i, due[mine]) - 1) // self.window
        order = np.argsort(rounds, kind="stable")
        step = max(1, TABLE_CELLS // len(plan.sizes))
        for a in range(0, len(at), step):
            some = order[a : a + step]
            which, row = np.unique(rounds[some], return_inverse=True)
            now, then = (plan.sent(np.minimum((which + s) * self.window, plan.total), self.quantum) for s in (0, 1))
            passed = then - now
            before = now.sum(1)[:, None] + np.cumsum(passed, axis=1) - passed
            out[some] = before[row, queue[some]] + at[some] - now[row, queue[some]]
        return out

    def pieces(self, queue: np.ndarray, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(document, start, length, place) of all pieces of documents that begin at `at` of their queues."""
        quanta = (at + n - 1) // self.quantum - at // self.quantum + 1
        doc = np.repeat(np.arange(len(at)), quanta)
        step = np.arange(len(doc)) - np.repeat(np.cumsum(quanta) - quanta, quanta)
        first = np.maximum((at[doc] // self.quantum + step) * self.quantum, at[doc])
        place = self.places(queue[doc], first)
        start = first - at[doc]
        size = np.r_[start[1:], 0] - start
        last = np.r_[doc[1:] != doc[:-1], True] if len(doc) else np.array([], bool)
        size[last] = n[doc[last]] - start[last]
        # Quanta that follow each other in the stream are one run; a run is cut where a sequence ends.
        new = np.r_[True, last[:-1] | (place[1:] != place[:-1] + size[:-1])] if len(doc) else np.array([], bool)
        head = np.flatnonzero(new)
        doc, start, place, size = doc[head], start[head], place[head], np.add.reduceat(size, head) if len(head) else size
        parts = (place + size - 1) // self.length - place // self.length + 1
        run = np.repeat(np.arange(len(doc)), parts)
        nth = np.arange(len(run)) - np.repeat(np.cumsum(parts) - parts, parts)
        low = np.maximum((place[run] // self.length + nth) * self.length, place[run])
        high = np.minimum((place[run] // self.length + nth + 1) * self.length, place[run] + size[run])
        return doc[run], start[run] + low - place[run], high - low, low


def pack(
    tokens: DataFrame, length: int = SEQUENCE, window: int | None = None, with_ids: bool = False, targets: Mapping[str | None, float] | None = None,
    quantum: int = QUANTUM,
) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    `targets` has a proportion above 0 for every source (default: its share of all tokens), `window` the
    tokens of a round (default: one sequence), `quantum` the tokens that a source sends at once.
    `tokens` is a stored result of `tokenized`. The table of sources (one row each) is
    part of the mix's definition and goes to every task as plain integers.
    """
    spans = settle(tokens.groupBy("source", "task").agg(F.sum("n").cast("bigint").alias("n")), "pack-spans")
    before = Window.partitionBy("source").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = settle(
        spans.df.select("source", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("bigint").alias("queue_start")),
        "pack-starts",
    )
    totals = [
        (r["source"], int(r["n"]))
        for r in spans.df.groupBy("source").agg(F.sum("n").alias("n")).orderBy(F.col("source").asc_nulls_last()).collect()
    ]
    placed = lookup_join(tokens, starts, ["source", "task"], ["doc_id"], null_safe=True).select(
        "doc_id", "source", (F.col("queue_start") + F.col("start")).alias("at"), "ids"
    )
    index = {name: i for i, (name, _) in enumerate(totals)}
    cutter = Cutter(Schedule([n for _, n in totals], weights_of(totals, targets)), length, window or length, quantum)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, 3):
                queue = np.array([index[s] for s in part.column(1).to_pylist()], np.int64)
                bytes_ = pc.binary_length(part.column(3)).to_numpy(zero_copy_only=False).astype(np.int64)
                doc, start, size, place = cutter.pieces(queue, part.column(2).to_numpy(), bytes_ // 4)
                raw = memoryview(b"".join(part.column(3).to_pylist()))
                low = 4 * start + (np.cumsum(bytes_) - bytes_)[doc]
                spans = list(zip(low.tolist(), (low + 4 * size).tolist()))
                sums = [zlib.crc32(raw[a:b]) for a, b in spans]
                columns = [part.column(0).take(pa.array(doc)), start, size, pa.array(sums, pa.int64()), bytes_[doc] // 4, place // length, place % length]
                columns += [pa.array([bytes(raw[a:b]) for a, b in spans], pa.binary())] * with_ids
                yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], names)

    schema = (
        "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
        + ", ids binary" * with_ids
    )
    names = [c.split()[0] for c in schema.split(", ")]
    return placed.mapInArrow(work, schema)


def pack_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """Tokenise once, then cut; `options` are those of `pack`."""
    return pack(stored(tokenized(docs, path, key, text, source), "pack-tokens"), **options)
