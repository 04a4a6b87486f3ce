"""Seeded, per-row randomness.

A draw depends only on (row key, salt, seed), so results are the same for any
partitioning, survive task retries, and can be restated in plain SQL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SEED = 42


def row_key(*parts: Column | str) -> Column:
    """One string key from several columns."""
    return F.concat_ws("|", *[_col(p).cast("string") for p in parts])


def digest(key: Column | str, salt: str, seed: int = DEFAULT_SEED) -> Column:
    """32 hex digits; sorting by them is a seeded permutation of the rows."""
    return F.md5(F.concat_ws("|", _col(key).cast("string"), F.lit(salt), F.lit(str(seed))))


def draw(key: Column | str, salt: str, seed: int = DEFAULT_SEED) -> Column:
    """Uniform integer in [0, 2^32)."""
    return F.conv(F.substring(digest(key, salt, seed), 1, 8), 16, 10).cast("bigint")


def chance(key: Column | str, salt: str, p: float, seed: int = DEFAULT_SEED) -> Column:
    """True with probability `p`."""
    return draw(key, salt, seed) / F.lit(float(2**32)) < F.lit(float(p))


def pick(items: Column, key: Column | str, salt: str, seed: int = DEFAULT_SEED) -> Column:
    """One element of an array column; null when the array is null or empty."""
    size = F.size(items)
    index = F.when(size > 0, draw(key, salt, seed) % size).cast("int")
    return F.get(items, index)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
