"""Readers for raw rows, templates, vocabularies and file listings."""

from __future__ import annotations

import io
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelloom.plans.ledger import storage
from labelloom.plans.shared import settle
from labelloom.schemas import TEMPLATES


FAIL = "FAILFAST"


def read_jsonl(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, mode: str = FAIL
) -> DataFrame:
    """One object per line. A malformed line fails the read; `mode="PERMISSIVE"` keeps what can be read."""
    return _reader(spark, schema).option("mode", mode).json(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, multiline: bool | None = None) -> DataFrame:
    """CSV with a header and doubled quotes.

    Multi-line values make a file unsplittable. By default (None) lines are looked at, in splits, for a quoted
    line end: a line with an odd number of quotes. Without one, files are read in splits. Name the format
    (`multiline`) to save that look.
    """
    if multiline is None:
        multiline = has_quoted_line_ends(spark, path)
    options = {"header": True, "multiLine": multiline, "escape": '"', "lineSep": None if multiline else "\n"}
    return _reader(spark, schema).options(**{k: v for k, v in options.items() if v is not None}).csv(path)


def has_quoted_line_ends(spark: SparkSession, path: str) -> bool:
    """Whether any line opens a quote that it does not close; the look ends at the first one found."""
    value = F.col("value")
    quotes = F.octet_length(value) - F.octet_length(F.replace(value, F.lit('"'), F.lit("")))
    return not spark.read.option("lineSep", "\n").text(path).filter(quotes % 2 == 1).isEmpty()


def read_json_document(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, mode: str = FAIL
) -> DataFrame:
    """Files that each hold one JSON array of records, or one object."""
    return _reader(spark, schema).options(multiLine=True, mode=mode).json(path)


def read_any_json(
    spark: SparkSession, path: str, schema: T.StructType | None = None, mode: str = FAIL
) -> DataFrame:
    """JSON lines and whole documents, told apart file by file.

    A file is read by lines if its first line that is not blank is a whole object, or a broken one before another; any other
    (an array, a printed object over several lines) is one document. Tasks open the files and read their beginnings; only how many there are of either
    kind comes back, and names of files where a folder holds both. Where tasks cannot open files (a store that Spark alone
    reaches) all lines are looked at once. Name the format (`.jsonl`, `read_json_document`) where it is known.
    """
    kinds = settle(json_kinds(spark, path), "json-kinds").df
    if kinds.filter("by_line IS NULL").isEmpty():
        seen = {r["by_line"]: r["n"] for r in kinds.groupBy("by_line").agg(F.count(F.lit(1)).alias("n")).collect()}
    else:
        kinds = settle(_kinds_of_all_lines(spark, path), "json-kinds").df
        seen = {r["by_line"]: r["n"] for r in kinds.groupBy("by_line").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not seen.get(False):
        return read_jsonl(spark, path, schema, mode)
    if not seen.get(True):
        return read_json_document(spark, path, schema, mode)
    # A folder of both kinds: each is read by the names of its files.
    named = {kind: sorted(r["key"] for r in kinds.filter(F.col("by_line") == kind).collect()) for kind in (True, False)}
    parts = read_jsonl(spark, named[True], schema, mode), read_json_document(spark, named[False], schema, mode)
    return parts[0].unionByName(parts[1], allowMissingColumns=True)


def json_kinds(spark: SparkSession, path: str) -> DataFrame:
    """(key, by_line) of each file that is not blank: true for lines, false for a document, null where it cannot be opened."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_pylist()
            found = [(k, _is_by_line(k)) for k in keys]
            kept = [(k, x) for k, x in found if x != "blank"]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in kept], pa.string()), pa.array([x for _, x in kept], pa.bool_())], ["key", "by_line"])

    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("key"))
    return files.mapInArrow(look, "key string, by_line boolean")


def _is_by_line(path: str) -> bool | str | None:
    """Whether a file holds an object a line; "blank" for a file without a line, None for one that cannot be opened.

    The first line that is not blank is a whole object, or opens one that is broken: then nothing follows, or a
    line that opens another.
    """
    try:
        files, at = storage(re.sub(r"^file:/+", "/", path))
        with files.open_input_stream(at) as source, io.TextIOWrapper(io.BufferedReader(source), "utf-8", errors="replace", newline="\n") as text:
            seen = (line.strip() for line in text if line.strip())
            first = next(seen, None)
            if first is None:
                return "blank"
            try:
                return isinstance(json.loads(first), dict)
            except ValueError:
                return first.startswith("{") and len(first) > 1 and next(seen, "{").startswith("{")
    except (OSError, pa.ArrowException, ValueError):
        return None


def _kinds_of_all_lines(spark: SparkSession, path: str) -> DataFrame:
    line = F.trim("value")
    looked = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("key")).filter(line != "")
    return looked.groupBy("key").agg(F.min(F.startswith(line, F.lit("{")) & (F.length(line) > 1)).alias("by_line"))


def load_raw(
    spark: SparkSession,
    identifier: str,
    schema: T.StructType | None = None,
    multiline: bool | None = None,
    mode: str = FAIL,
) -> DataFrame:
    """Load by suffix: `.jsonl`, `.csv`, other JSON; a name that is no path is taken as a catalog table.

    Give JSON a schema (such as `RAW_ROWS`) to save the pass that infers one.
    """
    try:
        if identifier.endswith(".jsonl"):
            return read_jsonl(spark, identifier, schema, mode)
        if identifier.endswith(".csv"):
            return read_csv(spark, identifier, schema, multiline)
        return read_any_json(spark, identifier, schema, mode)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return read_named(spark, identifier)


def read_named(spark: SparkSession, name: str) -> DataFrame:
    try:
        return spark.table(name)
    except Exception as problem:
        raise ValueError(f"Could not load dataset from {name}. Error: {problem}") from problem


def read_templates(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Template dictionaries (`category -> [templates]`) as rows; nothing for a missing or broken file.

    A file holds one dictionary, or with `lines` one dictionary per line.
    """
    try:
        text = spark.read.text(path, wholetext=not lines)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], TEMPLATES)
    return parse_templates(text, "value")


def parse_templates(df: DataFrame, col: str) -> DataFrame:
    lists = df.select(F.explode(F.from_json(F.col(col), "map<string,array<string>>")).alias("category", "_list"))
    return lists.select("category", F.posexplode("_list").alias("template_idx", "template")).withColumn(
        "template_idx", F.col("template_idx").cast("bigint")
    )


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """(idx, category) of a file holding one JSON array of labels; their order is kept."""
    text = spark.read.text(path, wholetext=True)
    labels = text.select(F.posexplode(F.from_json("value", "array<string>")).alias("idx", "category"))
    return labels.withColumn("idx", F.col("idx").cast("bigint"))


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(key, size) of the files under a path; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(F.col("path").alias("key"), F.col("length").alias("size"))


def _reader(spark: SparkSession, schema: T.StructType | None):
    return spark.read.schema(schema) if schema is not None else spark.read
