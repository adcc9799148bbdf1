"""op5: compression bands over whole documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import compression
from .registry import query, table


@query("op5_compression_bands")
def op5_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.judge(table(spark, sf_dir, "documents"))
