"""Parsed pages that last: each landed body is parsed once, however often its table is asked for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portalake.schema import Table
from portalake.session import exists
from portalake.sources.captures import FINGERPRINT
from portalake.sources.envelope import parse_pages

# What tells one landing of a page from another.
IDENTITY = ("capture_id", "page", "captured_at", FINGERPRINT)
MONTH = "captured_month"


def layer_folder(path: str, table: Table) -> str:
    """Where a layer keeps the pages of one operation."""
    return f"{path.rstrip('/')}/{table.service}/{table.name}"


def stored_pages(spark: SparkSession, path: str, table: Table) -> DataFrame | None:
    """The pages of one operation that a layer holds; None before the first."""
    folder = layer_folder(path, table)
    return spark.read.parquet(folder) if exists(spark, folder) else None


def _fingerprint(captures: DataFrame) -> Column:
    body = F.xxhash64("body")
    return F.coalesce(F.col(FINGERPRINT), body) if FINGERPRINT in captures.columns else body


def unknown(captures: DataFrame, held: DataFrame | None) -> DataFrame:
    """Captures that are not among the held pages, each once. Only what identifies them meets the
    pages."""
    marked = captures.withColumn(FINGERPRINT, _fingerprint(captures))
    if held is None:
        return marked
    known = held.select(*IDENTITY).distinct()
    same = None
    for c in IDENTITY:
        test = marked[c].eqNullSafe(known[c])
        same = test if same is None else same & test
    return marked.join(known, same, "left_anti")


def update_pages(captures: DataFrame, path: str, table: Table, which: Column | None = None) -> int:
    """Parse captures of one operation that the layer doesn't hold yet, of those that ``which`` chooses,
    and add them to it, by month of capture. Returns how many there were.

    What is new is first told from identities alone, which captures stored with fingerprints give
    without their bodies; the bodies are then read from the first to the last time of these.
    Without anything new nothing is parsed or written.
    """
    spark = captures.sparkSession
    mine = captures.where((F.col("service") == table.service) & (F.col("operation") == table.operation))
    mine = mine if which is None else mine.where(which)
    held = stored_pages(spark, path, table)
    span = unknown(mine, held).agg(F.count("*").alias("n"), F.min("captured_at").alias("first"), F.max("captured_at").alias("last"),
                                   F.count_if(F.col("captured_at").isNull()).alias("undated")).first()
    if not span["n"]:
        return 0
    if not span["undated"]:
        mine = mine.where(F.col("captured_at").between(F.lit(span["first"]), F.lit(span["last"])))
    pages = parse_pages(unknown(mine, held), table).withColumn(MONTH, F.coalesce(F.date_format("captured_at", "yyyy-MM"), F.lit("none")))
    (pages.hint("rebalance", MONTH).sortWithinPartitions(MONTH, "captured_at", "capture_id", "page")
     .write.mode("append").partitionBy(MONTH).parquet(layer_folder(path, table)))
    return span["n"]


def layer_pages(captures: DataFrame, path: str, table: Table, which: Column | None = None,
                captured: tuple[str | None, str | None] = (None, None)) -> DataFrame:
    """Pages of the captures chosen, from the layer, which is brought up to date for them first.
    Months outside ``captured`` are not opened."""
    update_pages(captures, path, table, which)
    pages = stored_pages(captures.sparkSession, path, table)
    if pages is None:
        return parse_pages(captures.limit(0), table)
    if which is not None:
        pages = pages.where(which)
    if captured[0]:
        pages = pages.where(F.col(MONTH) >= F.date_format(F.lit(captured[0]).cast("timestamp"), "yyyy-MM"))
    if captured[1]:
        pages = pages.where(F.col(MONTH) <= F.date_format(F.lit(captured[1]).cast("timestamp"), "yyyy-MM"))
    return pages.drop(MONTH)
