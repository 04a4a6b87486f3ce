"""Run tables that fill while a training runs.

Every micro-batch is written to partitions of its own, named by its number, and replaces what they hold. So a
batch that is replayed after a failure leaves the table as it was.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from labelloom.functions import fixed_values as V
from labelloom.operators.metrics import eval_metric_filter, progress_metrics, run_metrics

LIVE_SCHEMA = "key string, value double, step bigint, run_id string, stage string, batch_id bigint"
BEST_SCHEMA = "best_step bigint, best_value double, run_id string, batch_id bigint"


def write_batch(path: str, by: list[str]) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` sink to a parquet table with partitions of `by` and `batch_id`."""

    def write(rows: DataFrame, batch_id: int) -> None:
        numbered = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by, "batch_id").parquet(path)

    return write


def start_run_table(
    events: DataFrame, path: str, checkpoint: str, run_id: str, stage: str = "train", n: int = V.LOG_EVERY_STEPS, available_now: bool = False
) -> StreamingQuery:
    """Add the metric rows of streaming (step, epoch, logs) events to the run table at `path`."""
    rows = run_metrics(progress_metrics(events, n), run_id, stage)
    return _start(rows, "append", write_batch(path, ["run_id", "stage"]), checkpoint, available_now)


def read_run_table(spark: SparkSession, path: str) -> DataFrame:
    """(run_id, stage, key, value, step) of all batches."""
    return spark.read.schema(LIVE_SCHEMA).parquet(path).select("run_id", "stage", "key", "value", "step")


def start_best_checkpoint(
    events: DataFrame, path: str, checkpoint: str, run: str = "run_id", metric: str = "eval_loss", save_every: int = 20, available_now: bool = False
) -> StreamingQuery:
    """Keep the saved step with the lowest metric so far, per run, of streaming (run, step, logs) events.

    The state is one row a run. A batch writes the runs whose best it has seen again; the earliest step wins a tie.
    """
    logged = events.select(F.col(f"`{run}`").cast("string").alias("run_id"), "step", "logs")
    kept = eval_metric_filter(logged.withColumn("step", F.struct("run_id", "step")))
    saved = kept.filter((F.col("key") == metric) & (F.col("step.step") % save_every == 0))
    best = saved.groupBy(F.col("step.run_id").alias("run_id")).agg(F.min(F.struct("value", F.col("step.step").alias("step"))).alias("_best"))
    rows = best.select("run_id", F.col("_best.step").cast("bigint").alias("best_step"), F.col("_best.value").alias("best_value"))
    return _start(rows, "update", write_batch(path, ["run_id"]), checkpoint, available_now)


def best_so_far(spark: SparkSession, path: str) -> DataFrame:
    """(run_id, best_step, best_value): the last state of each run."""
    rows = spark.read.schema(BEST_SCHEMA).parquet(path)
    # A run's best only falls, so the least of its batches is the last.
    least = rows.groupBy("run_id").agg(F.min(F.struct("best_value", "best_step")).alias("_best"))
    return least.select("run_id", "_best.best_step", "_best.best_value")


def _start(rows: DataFrame, mode: str, sink: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = rows.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
