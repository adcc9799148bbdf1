"""op12: two tokenizations of every document, aligned."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import alignment
from .registry import query, table

FIRST, SECOND = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SIZES = (50_257, 32_000)


@query("op12_alignment")
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), lambda: alignment.byte_level(FIRST), lambda: alignment.pieces(SECOND), SIZES)[0]
