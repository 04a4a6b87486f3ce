"""A vocabulary as sorted files that tasks map into memory.

Words are dealt into files by a hash and sorted by it within each. A task opens the files that its words need, without reading
them whole, and looks words up by bisection; several tasks of a machine share the same pages. So a
vocabulary of any size is written by tasks, is never gathered, and rows that are looked up stay where they are.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import functions as F

from labelloom.plans.ledger import storage
from labelloom.plans.shared import Settled, fresh_path

FILE_WORDS = 2_000_000
OPEN_FILES = 256


def word_hashes(words: np.ndarray) -> np.ndarray:
    """64-bit hashes of an array of strings, the same in every process."""
    return pd.util.hash_array(words.astype(object), categorize=False).view(np.int64)


@dataclass(frozen=True)
class WordFiles:
    """(word, id) in `files` files below `path`."""

    path: str
    files: int

    def ids(self, words: pa.Array, unknown: int) -> np.ndarray:
        """The id of each of some different words; of a word that has several, the smallest."""
        out = np.full(len(words), unknown, np.int32)
        if not len(words):
            return out
        hashes = word_hashes(np.array(words.to_pylist(), object))
        home = hashes % self.files
        for number in np.unique(home).tolist():
            table = _open(self.path, number)
            if table is None:
                continue
            mine = np.flatnonzero(home == number)
            known, known_words, known_ids = table
            at = np.searchsorted(known, hashes[mine])
            # Words of one hash stand side by side; nearly always there is one.
            while len(mine):
                at, mine = at[at < len(known)], mine[at < len(known)]
                same = known[at] == hashes[mine]
                at, mine = at[same], mine[same]
                if not len(mine):
                    break
                hit = pc.equal(known_words.take(pa.array(at)), words.take(pa.array(mine)).cast(known_words.type)).to_numpy(zero_copy_only=False)
                out[mine[hit]] = known_ids[at[hit]]
                at, mine = at[~hit] + 1, mine[~hit]
        return out


@lru_cache(maxsize=OPEN_FILES)
def _open(path: str, number: int) -> tuple[np.ndarray, pa.Array, np.ndarray] | None:
    files, at = storage(path)
    name = f"{at}/{number:06d}.arrow"
    if files.get_file_info(name).type == pafs.FileType.NotFound:
        return None
    if not isinstance(files, pafs.LocalFileSystem):
        # A copy of the executor's own, to map; it can be made again at any time.
        copy = os.path.join(tempfile.gettempdir(), f"words-{uuid.uuid4().hex}")
        with files.open_input_stream(name) as source, open(copy, "wb") as out:
            while piece := source.read(1 << 22):
                out.write(piece)
        name = copy
    batch = pa.ipc.open_file(pa.memory_map(name)).get_batch(0)
    return batch.column(0).to_numpy(), batch.column(1), batch.column(2).to_numpy()


def write_word_files(vocabulary: Settled, word: str = "word", number: str = "token_id", files: int | None = None) -> WordFiles:
    """Write (word, id) rows; words may repeat, null ones are left out."""
    count = files or max(1, -(-vocabulary.rows // FILE_WORDS))
    path = fresh_path(vocabulary.df.sparkSession, "words")
    place, at = storage(path)
    place.create_dir(at, recursive=True)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = word_hashes(np.array(batch.column(0).to_pylist(), object)) if batch.num_rows else np.array([], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(h), pa.array(h % count)], ["word", "id", "hash", "file"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, folder = storage(path)

        def save(parts: list[pa.RecordBatch], file: int) -> None:
            table = pa.Table.from_batches(parts).select(["hash", "word", "id"]).combine_chunks()
            draft = f"{folder}/draft-{uuid.uuid4().hex}"
            with target.open_output_stream(draft) as sink, pa.ipc.new_file(sink, table.schema) as out:
                out.write_batch(table.to_batches()[0])
            target.move(draft, f"{folder}/{file:06d}.arrow")

        held: list[pa.RecordBatch] = []
        file = None
        for batch in batches:
            numbers = batch.column(3).to_numpy()
            edges = np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1]]) if len(numbers) else np.array([], int)
            for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(numbers)]):
                if held and numbers[a] != file:
                    save(held, file)
                    held = []
                file = int(numbers[a])
                held.append(batch.slice(a, b - a))
        if held:
            save(held, file)
        yield pa.RecordBatch.from_arrays([pa.array([len(held)], pa.int64())], ["n"])

    rows = vocabulary.df.select(F.col(f"`{word}`").alias("word"), F.col(f"`{number}`").cast("int").alias("id")).filter("word IS NOT NULL")
    keyed = rows.mapInArrow(hashed, "word string, id int, hash bigint, file bigint")
    dealt = keyed.repartition(count, "file").sortWithinPartitions("file", "hash", "word", "id")
    dealt.mapInArrow(write, "n bigint").write.format("noop").mode("overwrite").save()
    return WordFiles(path, count)
