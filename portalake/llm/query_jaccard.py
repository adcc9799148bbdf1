"""op3: groups of near copies among all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import jaccard
from .registry import query, table


@query("op3_jaccard_join")
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))
