"""Training-log events as a live metric table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from labelloom.functions import fixed_values as V
from labelloom.operators.metrics import progress_metrics


def start_metric_stream(
    events: DataFrame,
    path: str,
    checkpoint: str,
    n: int = V.LOG_EVERY_STEPS,
    available_now: bool = False,
) -> StreamingQuery:
    """Append metric rows of streaming (step, epoch, logs) events to a parquet table.

    Stateless, so it needs no watermark; the checkpoint makes the file sink exactly-once.
    """
    writer = (
        progress_metrics(events, n)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
