"""op4: quality of every document, learned from the labels of other remainders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import quality_model
from .common import remainder, settle
from .registry import query, table


@query("op4_quality_discriminant")
def op4_quality_discriminant(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = settle(quality_model.vectors(table(spark, sf_dir, "documents")), "quality")
    labels = (table(spark, sf_dir, "labels").where((remainder("doc_id", 3) != 1) & F.col("quality").isNotNull())
              .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("label")))
    model = quality_model.fit(vectors.join(labels, "doc_id").select("x", "label"))
    return (quality_model.score(vectors, model)
            .select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))
