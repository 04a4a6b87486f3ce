"""Query: mix `documents` to target weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.llm.common import read_table
from labelloom.llm.mixing import plan_mix
from labelloom.plans.joins import lookup_join


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = plan_mix(read_table(spark, sf_dir, "documents"))
    # Rows of two sources that are equal in id and text share a key.
    drawn = plan.mix.documents.groupBy("key", "source").agg(F.sum("words").cast("bigint").alias("taken")).alias("b")
    mine = (F.col("a.key") == F.col("b.key")) & F.col("a.source").eqNullSafe(F.col("b.source"))
    full = plan.taken.select("key", "source", "size").alias("a").join(drawn, mine, "left").select("a.key", "a.source", "size", "taken")
    named = lookup_join(full, plan.targets, ["source"], ["key"], null_safe=True)
    doc_id = F.split_part("key", F.lit("|"), F.lit(1))
    return named.select(
        F.when(doc_id != "", doc_id.cast("bigint")).alias("doc_id"),
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"),
    )


OP4_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint AS size,
         md5(concat_ws('|', concat_ws('|', coalesce(doc_id::varchar, ''), coalesce(md5(text), '-')) || '#1',
                       'mix', '42')) AS spot FROM documents),
totals AS (
  SELECT source, sum(size)::bigint AS source_size,
         ([5, 2, 1])[1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3]::double AS weight
  FROM sized GROUP BY source),
ranked AS (
  SELECT *, 3.0::double * source_size AS room,
         row_number() OVER (ORDER BY (3.0::double * source_size) / weight, encode(source) NULLS LAST) AS place FROM totals),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(room) OVER (
               ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::double
          / (sum(weight) OVER () - coalesce(sum(weight) OVER (
               ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM ranked),
final AS (SELECT arg_min(level, place) AS level FROM levels WHERE level <= room / weight),
targets AS (
  SELECT source, source_size, least(room, final.level * weight) AS target FROM levels, final),
quotas AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(round(target) / source_size) ELSE 0 END::bigint AS whole FROM targets),
placed AS (
  SELECT s.*, q.source_size, q.target, q.whole, round(q.target)::bigint - q.whole * q.source_size AS rest,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY spot
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM sized s JOIN quotas q ON s.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target,
       (whole * size + greatest(0, least(size, rest - (upto - size))))::bigint AS taken
FROM placed"""
