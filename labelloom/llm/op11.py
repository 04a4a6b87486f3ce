"""Query: rank `documents` for each `benchmark` item."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from labelloom.llm.common import read_table
from labelloom.llm.impacts import rank_documents


def op11_rank_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS doc, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
asked AS (
  SELECT DISTINCT item, item_id, term FROM (
    SELECT item, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS item, * FROM benchmark))),
corpus AS (SELECT count(*) AS n_docs, sum(len(terms))::bigint AS n_terms FROM words WHERE len(terms) > 0),
held AS (
  SELECT doc, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf
  FROM (SELECT doc, doc_id, len(terms) AS n, unnest(terms) AS term FROM words)
  WHERE term IN (SELECT term FROM asked) GROUP BY doc, term),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double))::bigint AS w
  FROM held, corpus GROUP BY term, n_docs),
scored AS (
  SELECT item, item_id, doc, any_value(doc_id) AS doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))))::bigint AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term), corpus GROUP BY item, item_id, doc),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::integer AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""
