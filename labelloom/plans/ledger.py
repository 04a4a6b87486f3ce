"""Answers of external calls, written as they come and read before calling.

A ledger is a folder that all executors reach. Requests are dealt into slices by a hash of their key.
A task takes a slice, reads the answers that the slice already has, calls for the others, a
few at a time, and writes each few as one file, which appears whole or not at all. So a task that is tried again,
or a run that is started again over the same ledger, repeats no call whose answer was written.
What a killed process can lose is the few that it was asking for.

One attempt works on a slice at a time: it leaves a claim, and another attempt waits until the slice is
answered, or until the claimant has written nothing for `lease` seconds. The claim of an earlier attempt of the same task
is void at once when Spark does not run attempts side by side.

A task holds the answers of one slice at a time, so slices and tasks follow the number and the bytes of the requests: a ledger that is
opened without their number is dealt when it is first used.

The ledger's answers are Parquet files, which `answers` reads as a table. They are the only copy of an answer that has to be stored:
`settle_calls` keeps the small fields of a run's answers, and `with_answers` reads a large one where it is needed.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.plans.shared import Settled, fresh_path, measure, settle

AT_ONCE = 16
LEASE_SECONDS = 300.0
SLICE_ROWS = 1000
SLICE_BYTES = 4 * 1024 * 1024
TASK_BYTES = 64 * 1024 * 1024
SHARE_BYTES = 256 * 1024 * 1024
MOST_SHARES = 4
PIECE_ROWS = 256
POLL_SECONDS = 0.2

Ask = Callable[[list[tuple]], list[tuple]]


def storage(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and plain path of a path or URI."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def answer_files(files: pafs.FileSystem, folder: str) -> list[pafs.FileInfo]:
    """The files of a slice's answers, in the order in which they were written."""
    found = files.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
    return sorted((f for f in found if f.is_file and f.base_name.endswith(".parquet")), key=lambda f: (f.mtime_ns or 0, f.path))


def read_answers(files: pafs.FileSystem, path: str, schema: pa.Schema) -> Iterator[tuple]:
    """The fields of `schema` in a file of answers."""
    table = pq.read_table(path, filesystem=files, schema=schema, columns=schema.names)
    return zip(*(column.to_pylist() for column in table.columns))


@dataclass(frozen=True)
class Ledger:
    """A folder of answers, dealt into a fixed number of slices; 0 slices: dealt by the first run that uses it."""

    path: str
    slices: int

    @staticmethod
    def open(path: str, requests: int = 0, tasks: int = 0, nbytes: int = 0) -> Ledger:
        """The ledger at `path`; a new one has slices for about so many requests of so many bytes."""
        files, at = storage(path)
        mark = f"{at}/slices"
        if not (requests or tasks or nbytes) and files.get_file_info(mark).type == pafs.FileType.NotFound:
            return Ledger(path, 0)
        if files.get_file_info(mark).type == pafs.FileType.NotFound:
            files.create_dir(at, recursive=True)
            with files.open_output_stream(mark) as out:
                out.write(str(max(tasks, -(-requests // SLICE_ROWS), -(-nbytes // SLICE_BYTES), 1)).encode())
        with files.open_input_stream(mark) as f:
            return Ledger(path, int(f.read().decode()))

    @staticmethod
    def fresh(spark: SparkSession, requests: int = 0) -> Ledger:
        """A new ledger of this application, in the shared folder."""
        path = fresh_path(spark, "ledger")
        return Ledger.open(path, requests, spark.sparkContext.defaultParallelism) if requests else Ledger(path, 0)

    def dealt(self, requests: Settled, tasks: int) -> Ledger:
        """The ledger with its number of slices, which a new one takes from its first requests."""
        return self if self.slices else Ledger.open(self.path, requests.rows, tasks, requests.nbytes)

    def answers(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """Everything answered so far; `schema` has the key and the answer's fields."""
        files, at = storage(self.path)
        files.create_dir(f"{at}/answers", recursive=True)
        # Two attempts that both lost track of each other can have asked twice; one answer counts.
        return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{self.path}/answers").dropDuplicates([schema.fields[0].name])


class Slice:
    """One slice of a ledger, as a task sees it; of the answers it holds the fields in `keep` (default: all)."""

    def __init__(self, ledger: Ledger, number: int, schema: pa.Schema, lease: float, side_by_side: bool, keep: list[str] | None = None):
        self.files, at = storage(ledger.path)
        self.folder, self.claims, self.pending = f"{at}/answers/{number:06d}", f"{at}/claims/{number:06d}", f"{at}/pending"
        self.schema, self.lease, self.side_by_side = schema, lease, side_by_side
        self.held = [i for i, name in enumerate(schema.names) if i and (keep is None or name in keep)]
        context = TaskContext.get()
        self.task = f"{context.stageId()}-{context.partitionId()}" if context else "none-0"
        self.attempt = context.attemptNumber() if context else 0
        self.claim = f"{self.claims}/{self.task}~{self.attempt}~{uuid.uuid4().hex}"
        self.known: dict = {}
        self.read: set[str] = set()

    def _listed(self, folder: str) -> list[pafs.FileInfo]:
        return [f for f in self.files.get_file_info(pafs.FileSelector(folder, allow_not_found=True)) if f.is_file]

    def refresh(self) -> None:
        """Read the answers written since."""
        some = pa.schema([self.schema.field(i) for i in [0, *self.held]])
        for info in answer_files(self.files, self.folder):
            if info.path not in self.read:
                for row in read_answers(self.files, info.path, some):
                    self.known.setdefault(row[0], row[1:])
                self.read.add(info.path)

    def write(self, rows: list[tuple]) -> None:
        table = pa.table([pa.array(list(c), f.type) for c, f in zip(zip(*rows), self.schema)], schema=self.schema)
        name = f"{uuid.uuid4().hex}.parquet"
        self.files.create_dir(self.pending, recursive=True)
        self.files.create_dir(self.folder, recursive=True)
        # Statistics would repeat the longest texts as they are.
        pq.write_table(table, f"{self.pending}/{name}", filesystem=self.files, compression="zstd", write_statistics=False)
        self.files.move(f"{self.pending}/{name}", f"{self.folder}/{name}")
        self.read.add(f"{self.folder}/{name}")
        self.known.update((r[0], tuple(r[i] for i in self.held)) for r in rows)

    def _owner(self) -> str | None:
        """The claim that counts: the first of those that are alive."""
        newest = max((f.mtime_ns or 0 for f in self._listed(self.folder)), default=0)
        alive = []
        for info in self._listed(self.claims):
            task, attempt, _ = info.base_name.split("~")
            void = not self.side_by_side and task == self.task and int(attempt) < self.attempt
            # What is read from a clock here decides who asks, not what is answered.
            if info.path == self.claim or not void and time.time() - max(info.mtime_ns or 0, newest) / 1e9 < self.lease:
                alive.append((info.mtime_ns or 0, info.path))
        return min(alive)[1] if alive else None

    def take(self, wanted: set) -> bool:
        """Whether this attempt is to ask for what is not answered; false once all is."""
        self.refresh()
        if wanted <= self.known.keys():
            return False
        self.files.create_dir(self.claims, recursive=True)
        with self.files.open_output_stream(self.claim):
            pass
        while self._owner() not in (None, self.claim):
            time.sleep(POLL_SECONDS)
            self.refresh()
            if wanted <= self.known.keys():
                break
        # The last owner may have written between the last reading and its end.
        self.refresh()
        return not wanted <= self.known.keys()

    def ask(self, rows: list[tuple], open_client: Callable[[], Ask], client: list, at_once: int) -> None:
        """Call for the rows (key, ...) that have no answer, `at_once` at a time, and write each of these calls' answers."""
        # Rows that share a key are asked for once.
        missing = [r for k, r in {r[0]: r for r in rows}.items() if k not in self.known]
        for at in range(0, len(missing), at_once):
            some = missing[at : at + at_once]
            if not client:
                client.append(open_client())
            self.write([(r[0], *a) for r, a in zip(some, client[0]([r[1:] for r in some]), strict=True)])

    def leave(self) -> None:
        if self.files.get_file_info(self.claim).type != pafs.FileType.NotFound:
            self.files.delete_file(self.claim)


def record_calls(
    requests: DataFrame | Settled,
    key: str,
    ask: list[str],
    answer: T.StructType,
    open_client: Callable[[], Ask],
    ledger: Ledger,
    at_once: int = AT_ONCE,
    tasks: int | None = None,
    lease: float = LEASE_SECONDS,
    keep: list[str] | None = None,
    share: tuple[int, int] = (0, 1),
) -> DataFrame:
    """(`key`, the fields of `answer`) for every row of `requests`; one call for each key that the ledger lacks.

    Fields that are not in `keep` (default: all) stay in the ledger only. `share` (i, n): the requests of every n-th slice from the i-th on.

    `open_client()` runs once per task that has to ask, and returns a function from a list of tuples (the `ask` columns) to
    as many tuples (the answer's fields). If it fails half-way through, the task fails; give such answers
    a field for errors instead. Rows with one key share an answer. The result may be computed again: it reads the
    ledger then. `tasks` defaults to the cluster's parallelism, or a task for every `TASK_BYTES` of requests if that is more.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    sized = requests if isinstance(requests, Settled) else measure(requests.select(*[F.col(f"`{c}`") for c in dict.fromkeys([key, *ask])]))
    requests = sized.df
    spark = requests.sparkSession
    at_share, shares = share
    many = tasks or tasks_for(spark, sized.nbytes // shares)
    ledger = ledger.dealt(sized, many)
    whole = T.StructType([requests.schema[key], *answer.fields])
    schema = T.StructType([f for i, f in enumerate(whole.fields) if not i or keep is None or f.name in keep])
    arrow, arrow_out = to_arrow_schema(whole), to_arrow_schema(schema)
    side_by_side = runs_side_by_side(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client: list = []
        of, number = None, None
        try:
            for batch in batches:
                numbers = batch.column("_slice").to_numpy()
                starts = np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1]]).tolist() if len(numbers) else []
                # Only the rows of one slice are turned into Python values at a time.
                for at, end in zip(starts, [*starts[1:], len(numbers)]):
                    if numbers[at] != number:
                        if of:
                            of.leave()
                        number = int(numbers[at])
                        of = Slice(ledger, number, arrow, lease, side_by_side, keep)
                    mine = list(zip(*(batch.column(c).slice(at, end - at).to_pylist() for c in [key, *ask])))
                    if of.take({r[0] for r in mine}):
                        of.ask(mine, open_client, client, at_once)
                    rows = [(r[0], *of.known[r[0]]) for r in mine]
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), arrow_out)], schema=arrow_out)
        finally:
            if of:
                of.leave()

    spread = F.pmod(F.xxhash64(key), F.lit(ledger.slices))
    dealt = requests.select(F.col(f"`{key}`"), *[F.col(f"`{c}`") for c in ask if c != key]).withColumn("_slice", spread)
    if shares > 1:
        dealt = dealt.filter(F.col("_slice") % shares == at_share)
    return dealt.repartition(many, "_slice").sortWithinPartitions("_slice", key).mapInArrow(run, schema)


def settle_calls(
    requests: Settled,
    key: str,
    ask: list[str],
    answer: T.StructType,
    open_client: Callable[[], Ask],
    ledger: Ledger,
    keep: list[str],
    at_once: int = AT_ONCE,
) -> Settled:
    """`record_calls`, run now: (`key`, the fields in `keep`) is written, the other fields stay in the ledger only.

    Large requests are dealt a share of the slices at a time, so that no more than that share of their bytes lies in shuffle files;
    `requests.df` is read once a share.
    """
    spark = requests.df.sparkSession
    ledger = ledger.dealt(requests, tasks_for(spark, requests.nbytes))
    shares = min(MOST_SHARES, ledger.slices, max(1, -(-requests.nbytes // SHARE_BYTES)))
    parts = [
        settle(record_calls(requests, key, ask, answer, open_client, ledger, at_once, keep=keep, share=(i, shares)), "calls")
        for i in range(shares)
    ]
    return Settled(reduce(DataFrame.unionByName, [p.df for p in parts]), sum(p.rows for p in parts), sum(p.nbytes for p in parts))


def with_answers(rows: DataFrame, call: str, key: str, field: T.StructField, ledger: Ledger, tasks: int, row_key: str) -> DataFrame:
    """`rows` with an answer's `field`, read from the ledger under `key`: that of column `call`, which must be there; null where `call` is.

    Rows are dealt by slice, and a task reads one slice at a time. If the field is not used later, nothing is read; columns of
    `rows` that are not used later are not moved.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    named = to_arrow_schema(T.StructType([T.StructField(key, rows.schema[call].dataType), field]))

    def look_up(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        files, at = storage(ledger.path)
        number, known = None, {}
        for numbers, calls in batches:
            numbers = numbers.to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1]]).tolist() if len(numbers) else []
            for start, end in zip(cuts, [*cuts[1:], len(numbers)]):
                for piece in range(start, end, PIECE_ROWS):
                    wanted = calls.slice(piece, min(PIECE_ROWS, end - piece)).to_pylist()
                    if numbers[start] != number and any(c is not None for c in wanted):
                        number, known = int(numbers[start]), {}
                        for info in answer_files(files, f"{at}/answers/{number:06d}"):
                            for name, value in read_answers(files, info.path, named):
                                known.setdefault(name, value)
                    yield pa.array([None if c is None else known[c] for c in wanted], named.field(1).type)

    # A step that has to find its rows in the order of the slices: a filter on the answer must not be moved below it.
    answer = F.arrow_udf(look_up, field.dataType).asNondeterministic()
    slices = F.lit(ledger.slices)
    spread = F.when(F.col(call).isNotNull(), F.pmod(F.xxhash64(call), slices)).otherwise(F.pmod(F.xxhash64(F.col(f"`{row_key}`")), slices))
    dealt = rows.withColumn("_slice", spread).repartition(tasks, "_slice").sortWithinPartitions("_slice")
    return dealt.withColumn(field.name, answer("_slice", call)).drop("_slice")


def tasks_for(spark: SparkSession, nbytes: int) -> int:
    """The cluster's parallelism, or a task for every `TASK_BYTES` if that is more."""
    return max(spark.sparkContext.defaultParallelism, -(-nbytes // TASK_BYTES))


def runs_side_by_side(spark: SparkSession) -> bool:
    """Whether Spark may run two attempts of a task at once."""
    return (spark.conf.get("spark.speculation", None) or spark.sparkContext.getConf().get("spark.speculation", "false")).lower() == "true"
