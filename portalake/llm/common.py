"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session
from ..session import shared_folder, tidied  # noqa: F401

#: What counts as white space between words, as a Java character class.
SPACES = r"[\x20\x09-\x0D]"


def tune(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, so that a Python task holds few long texts at a time, and shuffle
    files that go when the query that wrote them has ended."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def settle(df: DataFrame, what: str) -> DataFrame:
    """Rows that later steps use more than once, computed once and stored in the shared folder.
    They outlive a lost executor, and the lineage ends there."""
    return session.settle(df, f"llm-{what}")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone, a missing text as an empty one. Other columns, also such
    as have names the operators use inside, are left out here."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def remainder(id_col: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``. A null id has remainder 0."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % n, F.lit(0))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "replace").lower().split()


def string_column(batch, name: str) -> Iterable[str]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()
