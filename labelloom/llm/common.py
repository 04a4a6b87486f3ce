"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.plans.shared import fresh_path, shuffles_dropped

# One ASCII blank or one of tab, line feed, vertical tab, form feed, carriage return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` to the shared folder and return the written table."""
    path = fresh_path(df.sparkSession, purpose)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of `edges(a, b)`; root is the smallest node of its component.

    Alternates the large-star and small-star steps, each a map-side combined
    minimum and one join. Every round is written to the shared folder, so a lost
    executor repeats one round at most. No list of neighbours is ever gathered.
    Self-loops, repeated and reversed edges are allowed. Rounds grow with the logarithm of the longest path; beyond
    `max_rounds` of them it raises instead of giving an unfinished result.
    """
    spark = edges.sparkSession
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(lowest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.distinct()
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        now = stored(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()
        if tuple(mark) == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        seen = tuple(mark)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
