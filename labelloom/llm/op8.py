"""Query: write `pages` to WARC archives and read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from labelloom.llm.common import read_table
from labelloom.llm.warc import page_of, write_and_read


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = write_and_read(read_table(spark, sf_dir, "pages"))
    return records.select(
        page_of("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        records["kind"].alias("record_type"),
        page_of("refers_to").alias("refers_to"),
    )


OP8_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, octet_length(encode(coalesce(html, '')))::bigint AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT payload_digest, max(page_id) AS keeper FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, p.payload_digest,
       CASE WHEN keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM p LEFT JOIN g USING (payload_digest)"""
