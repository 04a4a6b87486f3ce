"""Writers for raw rows, splits, vocabularies, examples and run tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.operators.metrics import run_metrics, run_params


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per row, null fields included."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_splits(conversations: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines of `messages` in one folder per split; an empty split leaves no folder."""
    df = conversations.select("split", "messages")
    df.write.mode(mode).option("ignoreNullFields", "false").partitionBy("split").json(path)


def vocabulary_json(vocabulary: DataFrame) -> DataFrame:
    """One row with the labels as a sorted JSON array; no row when there are none."""
    return (
        vocabulary.agg(F.array_sort(F.collect_set("category")).alias("_labels"))
        .filter(F.size("_labels") > 0)
        .select(F.to_json("_labels").alias("value"))
    )


def write_vocabulary(vocabulary: DataFrame, path: str, mode: str = "errorifexists") -> bool:
    """Write the JSON array as one text file; False, and nothing written, without labels."""
    if vocabulary.isEmpty():
        return False
    vocabulary_json(vocabulary).coalesce(1).write.mode(mode).text(path)
    return True


def write_examples_csv(examples: DataFrame, path: str, mode: str = "errorifexists") -> None:
    examples.coalesce(1).write.mode(mode).options(header=True, quote='"', escape='"').csv(path)


def write_run_metrics(metrics: DataFrame, path: str, run_id: str, stage: str) -> None:
    """Append (key, value) rows to the parquet run table; a repeated stage replaces its own rows."""
    rows = run_metrics(metrics, run_id, stage)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "stage").parquet(path)


def write_run_params(params: DataFrame, path: str, run_id: str) -> None:
    """Write (key, value) rows to the parquet parameter table; a repeated run replaces its own rows."""
    rows = run_params(params, run_id)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)
