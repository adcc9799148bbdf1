"""op10: language model scores of every document, learned from those of other remainders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import maxent
from .common import remainder, texts
from .registry import query, table


@query("op10_maxent_scores")
def op10_maxent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(table(spark, sf_dir, "documents"))
    model, found, counts = maxent.fit(docs.where(remainder("doc_id", 10) != 0))
    return (maxent.score(docs, model, found, counts)
            .select("doc_id", (remainder("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known",
                    F.lit(found.n).cast("long").alias("train_tokens"), "base_score", "score"))
