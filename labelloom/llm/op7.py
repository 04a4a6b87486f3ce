"""Query: verdicts on the urls of `pages`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from labelloom.llm.common import read_table
from labelloom.llm.urls import judge_urls


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "odds")
