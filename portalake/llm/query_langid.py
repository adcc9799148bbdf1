"""op8: the language of every document, learned from those of other remainders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import langid
from .common import remainder
from .registry import query, table


def learned(docs: DataFrame) -> langid.Model:
    """A model from the documents that are not held out (crc32 of the id modulo 4 is not 2)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), "lang")
    return langid.fit(rows.where(remainder("doc_id", 4) != 2))


@query("op8_language_codes")
def op8_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return (langid.predict(docs, learned(docs))
            .select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "ambiguous"))
