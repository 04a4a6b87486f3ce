"""Lookup joins that stay safe whatever the sizes and key skew."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.plans.shared import Settled, measure, settle

BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
HOT_ROWS = 2_000_000


def fits_broadcast(table: Settled, max_bytes: int = BROADCAST_BYTES) -> bool:
    return table.rows <= BROADCAST_ROWS and table.nbytes <= max_bytes


def lookup_join(
    big: DataFrame,
    table: DataFrame | Settled,
    on: list[str],
    row_key: list[str],
    how: str = "left",
    null_safe: bool = False,
    max_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join `big` to a lookup table whose keys are unique.

    A table of measured small size is broadcast, so `big` is never shuffled. With a
    larger one both sides are shuffled, and a key that `big` holds more than
    `hot_rows` times is shared out: its rows go to several slots by a hash of
    their row key, and only that key's table row is repeated per slot.
    """
    sized = table if isinstance(table, Settled) else measure(table)
    if fits_broadcast(sized, max_bytes):
        return _equi_join(big, F.broadcast(sized.df), on, how, null_safe)
    hot = settle(_hot_keys(big, on, hot_rows), "hot-keys")
    if hot.rows == 0:
        return _equi_join(big, sized.df, on, how, null_safe)
    # At most (rows of `big`) / hot_rows keys are hot.
    tags = F.broadcast(hot.df) if fits_broadcast(hot) else hot.df
    slots = F.coalesce("_slots", F.lit(1))
    salted = _equi_join(big, tags, on, "left", True).withColumn(
        "_slot", F.pmod(F.xxhash64(*row_key), slots).cast("int")
    )
    repeated = _equi_join(sized.df, tags, on, "left", True).withColumn(
        "_slot", F.explode(F.sequence(F.lit(0), slots.cast("int") - 1))
    )
    joined = _equi_join(salted.drop("_slots"), repeated.drop("_slots"), [*on, "_slot"], how, null_safe)
    return joined.drop("_slot")


def _hot_keys(big: DataFrame, on: list[str], hot_rows: int) -> DataFrame:
    counts = big.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > hot_rows).select(*on, F.ceil(F.col("_n") / hot_rows).alias("_slots"))


def _equi_join(left: DataFrame, right: DataFrame, on: list[str], how: str, null_safe: bool) -> DataFrame:
    if not null_safe:
        return left.join(right, on, how)
    keys = {c: f"_key_{c}" for c in on}
    right = right.withColumnsRenamed(keys)
    match = reduce(
        lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"`{k}`")) for c, k in keys.items()]
    )
    return left.join(right, match, how).drop(*keys.values())
