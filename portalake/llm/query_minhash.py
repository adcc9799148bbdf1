"""op13: near-duplicate documents by min-hash, verified in batches of the signature."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import minhash
from .registry import query, table


@query("op13_minhash_dedup")
def op13_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.groups(table(spark, sf_dir, "documents"))
