"""Shared bindings of operators to the given tables, in DataFrame and SQL form."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.functions.hashing import DEFAULT_SEED

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


class Registry(dict[str, Entry]):
    """Collects queries through a decorator."""

    def add(self, name: str, sql: str | None = None):
        def register(run: Query) -> Query:
            if name in self:
                raise KeyError(f"duplicate query {name}")
            self[name] = Entry(run, sql)
            return run

        return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; documents in a handful of splits are dealt out, so that all cores have work.

    Inputs with a quarter as many splits as there are cores, or more, are left as they are.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name != "documents":
        return df
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores, "doc_id") if 4 * df.rdd.getNumPartitions() <= cores else df


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`documents` as raw labelled rows (category = language)."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"),
        F.col("text").alias("job_description_text"),
        F.col("lang").alias("category_label"),
        "source",
    )


RAW_SQL = """
raw AS (
  SELECT doc_id AS row_id, text AS job_description_text, lang AS category_label, source FROM documents
)"""

# --- SQL restatements of the shared helpers ---

SQL_WORD = r"[\p{L}\p{N}_]"
SQL_WS = (
    r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def sql_digest(key: str, salt: str, seed: int = DEFAULT_SEED) -> str:
    return f"md5(concat_ws('|', {key}, '{salt}', '{seed}'))"


def sql_draw(key: str, salt: str, seed: int = DEFAULT_SEED) -> str:
    return f"cast('0x' || substring({sql_digest(key, salt, seed)}, 1, 8) AS bigint)"


def sql_chance(key: str, salt: str, p: float) -> str:
    return f"({sql_draw(key, salt)} / 4294967296.0::double < {p}::double)"


def sql_strip(text: str) -> str:
    return f"regexp_replace({text}, '\\A{SQL_WS}+|{SQL_WS}+\\z', '', 'g')"


def sql_squeeze(text: str) -> str:
    return f"trim(regexp_replace({text}, '{SQL_WS}+', ' ', 'g'), ' ')"


def sql_clean(text: str) -> str:
    marker = rf"\[[A-Z]{{2,}}_(?:UNTRANSLATED|NO_TRANSLATE_CLIENT|FAILED_{SQL_WORD}+|ERROR)\]"
    unmarked = f"regexp_replace({text}, '{marker}', '', 'g')"
    unmarked = rf"regexp_replace({unmarked}, '\[[A-Z_]+\]', '', 'g')"
    return f"coalesce({sql_squeeze(unmarked)}, 'None')"


def sql_quotas(source: str, label: str = "category_label", test: float = 0.15, val: float = 0.15) -> str:
    """CTEs ending in `quotas(stratum, n, n_test, n_validation)` over the rows of `source`."""
    return f"""
counts AS (SELECT {label} AS stratum, count(*)::hugeint AS n FROM {source} GROUP BY 1),
kept0 AS (
  SELECT *, sum(n) OVER () AS total,
         (sum(n) OVER () - ceil({test}::double * sum(n) OVER ()))::hugeint AS keep FROM counts),
kept1 AS (
  SELECT *, (n * keep) // total AS base,
         row_number() OVER (ORDER BY (n * keep) % total DESC, stratum) AS place FROM kept0),
kept AS (
  SELECT stratum, n, base + CASE WHEN place <= keep - sum(base) OVER () THEN 1 ELSE 0 END AS kept FROM kept1),
trained0 AS (
  SELECT *, sum(kept) OVER () AS total,
         (sum(kept) OVER () - ceil({val}::double * sum(kept) OVER ()))::hugeint AS keep FROM kept),
trained1 AS (
  SELECT *, (kept * keep) // total AS base,
         row_number() OVER (ORDER BY (kept * keep) % total DESC, stratum) AS place FROM trained0),
quotas AS (
  SELECT stratum, n, n - kept AS n_test,
         kept - base - CASE WHEN place <= keep - sum(base) OVER () THEN 1 ELSE 0 END AS n_validation
  FROM trained1)"""


def sql_split(source: str, label: str = "category_label", key: str = "row_id",
              test: float = 0.15, val: float = 0.15) -> str:
    """CTEs ending in `parts(source columns, split)`."""
    return f"""{sql_quotas(source, label, test, val)},
ranked AS (
  SELECT s.*, row_number() OVER (
    PARTITION BY {label} ORDER BY {sql_digest(key, 'split')}, {key}) AS place FROM {source} s),
parts AS (
  SELECT r.* EXCLUDE (place), CASE WHEN place <= q.n_test THEN 'test'
         WHEN place <= q.n_test + q.n_validation THEN 'validation' ELSE 'train' END AS split
  FROM ranked r JOIN quotas q ON {label if '.' in label else 'r.' + label} = q.stratum)"""
