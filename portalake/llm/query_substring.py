"""op2: repeated passages cut out of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import substring
from .registry import query, table


@query("op2_substring_dedup")
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.dedup(docs).select("doc_id", "dedup.n_units", "dedup.n_removed", "dedup.removed", "text")
