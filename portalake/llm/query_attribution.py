"""op6: tokens of every line of every document, each document encoded once as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import attribution
from .query_bpe import PATTERN, RANKS
from .registry import query, table


@query("op6_token_attribution")
def op6_token_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution.count(table(spark, sf_dir, "documents"), RANKS, PATTERN)
