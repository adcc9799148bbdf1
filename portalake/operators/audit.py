"""Is every fetch complete? Judged from page counts alone, before any row is used."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Pages whose running count one task takes; a capture of any length is many such blocks.
BLOCK = 1000


def _same(a: DataFrame, b: DataFrame, *columns: str) -> Column:
    condition = a["capture_id"].eqNullSafe(b["capture_id"])
    for c in columns:
        condition &= a[c] == b[c]
    return condition


def _counted(pages: DataFrame) -> DataFrame:
    """The facts of each page, copies folded, with the number of rows and of pages up to it
    (``rows``, ``nth``), counted in two levels."""
    copied = F.min("fingerprint") != F.max("fingerprint") if "fingerprint" in pages.columns else F.count(F.lit(1)) > 1
    number = F.when(F.col("page") >= 1, F.col("page").cast("bigint")).otherwise(0)
    narrow = (pages.withColumn("page", number)
              .groupBy("capture_id", "page")
              .agg(copied.alias("copied"),
                   F.max("num_of_rows").alias("num_of_rows"),
                   F.max("n").cast("bigint").alias("n"), F.max("total").alias("total"),
                   F.max("status").alias("page_status"),
                   F.max("code").alias("code"), F.max("message").alias("message"))
              .withColumn("block", F.expr(f"page div {BLOCK}")))
    blocks = narrow.groupBy("capture_id", "block").agg(F.sum("n").alias("bn"), F.count(F.lit(1)).alias("bp"))
    before = Window.partitionBy("capture_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("capture_id", "block", F.coalesce(F.sum("bn").over(before), F.lit(0)).alias("rows_before"),
                           F.coalesce(F.sum("bp").over(before), F.lit(0)).alias("pages_before"))
    in_order = Window.partitionBy("capture_id", "block").orderBy("page")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = narrow.select("*", F.sum("n").over(so_far).alias("in_block"), F.row_number().over(in_order).alias("place"))
    return (counted.join(starts, _same(counted, starts, "block"))
            .select(counted["*"], (F.col("rows_before") + F.col("in_block")).alias("rows"),
                    (F.col("pages_before") + F.col("place")).alias("nth")))


def page_starts(pages: DataFrame) -> DataFrame:
    """``capture_id, page, rows_before``: the rows of a fetch on the pages before. No task takes more than
    a block of pages of one capture."""
    return _counted(pages).select("capture_id", "page", (F.col("rows") - F.col("n")).alias("rows_before"))


def in_order(pages: DataFrame) -> DataFrame:
    """Pages with ``rows_before``, from which ``raw_rows`` gives each row its place in the whole fetch
    (``ordinal``). Pages without a number have none."""
    starts = page_starts(pages)
    return (pages.join(starts, _same(pages, starts, "page"), "left")
            .select(pages["*"], starts["rows_before"]))


def page_audit(pages: DataFrame) -> DataFrame:
    """One row per capture: ``status``, ``rows``, ``total``, ``last_page``, ``code``,
    ``message``.

    Pages are judged in order and the first page that ends the fetch decides: the declared
    total is reached (``complete``) or passed (``duplicated``), an empty page comes too early
    (``truncated``), a short page ends a fetch without totals (``complete``), or the page
    itself failed (its own status). A page number missing from the sequence is
    ``incomplete``, and so is a page without a number from 1 up. A page landed twice counts
    once if its copies are alike (``fingerprint``), else the fetch is ``repeated``.

    Only the narrow page columns are shuffled, copies folded before it. The running count of
    rows is taken in two levels, over blocks of pages and within a block, so that a capture
    of any number of pages is spread over tasks.
    """
    judged = _counted(pages)
    rows, total, n = F.col("rows"), F.col("total"), F.col("n")
    outcome = (F.when(F.col("nth") != F.col("page"), "incomplete")
               .when(F.col("copied"), "repeated")
               .when(~F.col("page_status").isin("ok", "no_data"), F.col("page_status"))
               .when(rows > total, "duplicated")
               .when(rows == total, "complete")
               .when(total.isNotNull() & (n == 0), "truncated")
               .when(total.isNull() & ((n == 0) | (n < F.col("num_of_rows"))), "complete"))
    unnumbered = F.col("page") == 0
    facts = F.struct(F.col("page"), outcome.alias("outcome"), rows.alias("rows"), total.alias("total"), F.col("code"),
                     F.when(unnumbered, "a page without a number").otherwise(F.col("message")).alias("message"))
    folded = judged.groupBy("capture_id").agg(
        F.min(F.when(outcome.isNotNull(), facts)).alias("end"),
        F.max("page").alias("pages"), F.sum("n").alias("seen"))
    end = F.col("end")
    return folded.select(
        "capture_id",
        F.coalesce(end["outcome"], F.lit("incomplete")).alias("status"),
        F.coalesce(end["rows"], F.col("seen")).alias("rows"),
        end["total"].alias("total"),
        F.nullif(F.coalesce(end["page"], F.col("pages")), F.lit(0)).cast("int").alias("last_page"),
        F.when(end["outcome"] != "complete", end["code"]).alias("code"),
        F.when(end["outcome"] != "complete", end["message"]).alias("message"),
    )


def complete_only(pages: DataFrame, audit: DataFrame) -> DataFrame:
    """Pages of complete fetches, up to the page that ended each; all or nothing per fetch.

    Joined page by page, before rows are taken out of their arrays. The audit side is
    broadcast only if Spark measures it small enough; otherwise both sides are shuffled and
    adaptive execution splits a hot capture. Of a page landed more than once, one copy is
    kept; they are alike, or the fetch would not be complete.
    """
    good = audit.where(F.col("status") == "complete").select("capture_id", F.col("last_page").alias("_last"))
    kept = (pages.join(good, _same(pages, good)).where(F.col("page") <= F.col("_last"))
            .select(pages["*"]))
    copied = (pages.groupBy("capture_id", "page").agg(F.count(F.lit(1)).alias("_copies"))
              .where("_copies > 1 and page is not null"))
    marked = kept.join(copied, _same(kept, copied, "page"), "left")
    # Only pages that have copies are shuffled with their rows.
    once = marked.where(F.col("_copies").isNull()).select(kept["*"])
    folded = marked.where(F.col("_copies").isNotNull()).select(kept["*"]).dropDuplicates(["capture_id", "page"])
    return once.unionByName(folded)


def refused(audit: DataFrame) -> DataFrame:
    """Fetches that yield no rows because they failed or are not whole, with the reason."""
    return audit.where(F.col("status") != "complete")
