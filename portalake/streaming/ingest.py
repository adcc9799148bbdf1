"""The same parse and clean on captures as they arrive.

Parse and clean look at one body at a time, so they run unchanged on a stream. Whether a fetch
is complete can be told only from all its pages, which may come in several batches. The sink
keeps state for each fetch that has not ended: the counts of its pages and the batches they came
in, no rows. A batch reads the state the one before left, the new pages' counts, and of the
pages kept only the batches of the fetches that end with it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portalake.operators.audit import complete_only, page_audit
from portalake.operators.clean import clean
from portalake.session import exists, folders, remove, settle, tidied
from portalake.sinks.tables import upsert_table
from portalake.sources.captures import CAPTURE_SCHEMA
from portalake.sources.envelope import LINEAGE, parse_pages, raw_rows
from portalake.tables import table as find_table

#: What is kept of a page of a fetch that has not ended; of one that has (kind ``done``) its id and
#: time, so that pages landed after it are told; and the latest time seen (kind ``clock``).
FACTS = ("capture_id string, page int, captured_at timestamp, num_of_rows int, fingerprint long, status string, code string, "
         "message string, total long, n int, batch long")
STATE = f"kind string, {FACTS}"
_FACTS = [x.split()[0] for x in FACTS.split(", ")]


def stream_captures(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Captures newly landed in a parquet folder."""
    return (spark.readStream.schema(CAPTURE_SCHEMA).option("maxFilesPerTrigger", files_per_batch)
            .parquet(path))


def typed_stream(captures: DataFrame, name: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed rows of a declared table, body by body: for looking on, not for storing, as rows of
    fetches that turn out incomplete are among them."""
    t = find_table(name)
    mine = captures.where((F.col("service") == t.service) & (F.col("operation") == t.operation))
    return clean(raw_rows(parse_pages(mine, t)), t, keep)


def _facts(pages: DataFrame) -> DataFrame:
    return pages.select(*(F.col(n).cast(t).alias(n) for n, t in (x.split() for x in FACTS.split(", "))))


def _state(spark: SparkSession, landed: str, batch_id: int) -> DataFrame:
    folder = f"{landed}/state/{batch_id}"
    return spark.read.schema(STATE).parquet(folder) if exists(spark, folder) else spark.createDataFrame([], STATE)


def _only(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    return rows.join(ids, rows["capture_id"].eqNullSafe(ids["capture_id"]), how)


def _advance(before: DataFrame, fresh: DataFrame, patience: str) -> tuple[DataFrame, DataFrame]:
    """The state a batch leaves, and the audit of the fetches it ends: by their pages, or because
    nothing of them came for as long as ``patience``, or as pages of a fetch that had ended
    (``late``)."""
    done = before.where("kind = 'done'")
    known = done.select("capture_id").distinct()
    late = _only(fresh, known, "left_semi")
    pages = before.where("kind = 'page'").select(*_FACTS).unionByName(_only(fresh, known, "left_anti"))
    clock = before.where("kind <> 'page'").select("captured_at").unionByName(fresh.select("captured_at")).agg(F.max("captured_at").alias("clock"))
    horizon = F.col("clock") - F.expr(f"interval {patience}")

    audit = page_audit(pages)
    last = pages.groupBy("capture_id").agg(F.max("captured_at").alias("captured_at"))
    judged = audit.join(last, audit["capture_id"].eqNullSafe(last["capture_id"])).select(audit["*"], last["captured_at"]).crossJoin(F.broadcast(clock))
    given_up = (F.col("status") == "incomplete") & (F.col("captured_at") < horizon)
    ended = settle(judged.where((F.col("status") != "incomplete") | given_up)
                   .select("capture_id", F.when(given_up, "timed out").otherwise(F.col("status")).alias("status"), "rows", "total", "last_page", "code", "message", "captured_at"), "ended")
    pages_left = _only(pages, ended.select("capture_id"), "left_anti").select(F.lit("page").alias("kind"), *_FACTS)
    blank = lambda rows, kind: rows.select(F.lit(kind).alias("kind"), *(
        F.col(c) if c in rows.columns else F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in FACTS.split(", "))))
    remembered = done.select("capture_id", "captured_at").crossJoin(F.broadcast(clock)).where(F.col("captured_at") >= horizon).drop("clock")
    after = (pages_left.unionByName(blank(ended.select("capture_id", "captured_at"), "done")).unionByName(blank(remembered, "done"))
             .unionByName(blank(clock.select(F.col("clock").alias("captured_at")), "clock")))
    came_late = late.groupBy("capture_id").agg(F.count("*").alias("rows"), F.max("captured_at").alias("captured_at"))
    notes = ended.unionByName(came_late.select("capture_id", F.lit("late").alias("status"), F.col("rows").cast("long"), F.lit(None).cast("long").alias("total"),
                                               F.lit(None).cast("int").alias("last_page"), F.lit(None).cast("string").alias("code"),
                                               F.lit("pages of a fetch that had ended").alias("message"), "captured_at"))
    return after, notes


def upsert_batches(name: str, path: str, landed: str, patience: str = "30 days") -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink of captures into a stored keyed table.

    Parsed pages are kept by batch below ``landed``. A fetch is merged with the batch that brings its
    last page, from the batches its pages came in; one that fails, or of which nothing came for
    ``patience`` (by capture time), or whose page comes after it has ended, is noted below
    ``landed/ended`` with its status, and brings no rows. State older than the batch before, and pages
    that no open fetch needs, are deleted, so that a batch costs what it brings and what is open,
    however long the stream has run.

    A batch that is run again reads the same state, writes the same pages and merges the same rows.
    """
    t = find_table(name)

    def sink(batch: DataFrame, batch_id: int) -> None:
        tidied(lambda: take(batch, batch_id), batch.sparkSession)

    def take(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mine = batch.where((F.col("service") == t.service) & (F.col("operation") == t.operation))
        kept = f"{landed}/pages"
        parsed = parse_pages(mine, t)
        parsed.write.mode("overwrite").parquet(f"{kept}/batch={batch_id}")
        schema = parsed.withColumn("batch", F.lit(0).cast("long")).schema
        before = _state(spark, landed, batch_id - 1)
        fresh = _facts(spark.read.schema(schema).parquet(kept).where(F.col("batch") == batch_id))
        after, notes = _advance(before, fresh, patience)
        after.write.mode("overwrite").parquet(f"{landed}/state/{batch_id}")
        notes.write.mode("overwrite").parquet(f"{landed}/ended/batch={batch_id}")

        notes = spark.read.parquet(f"{landed}/ended/batch={batch_id}")
        whole = notes.where("status = 'complete'").select("capture_id", "last_page")
        facts = before.where("kind = 'page'").select(*_FACTS).unionByName(fresh)
        batches = sorted(r[0] for r in _only(facts, whole.select("capture_id"), "left_semi").select("batch").distinct().collect())
        if batches:
            pages = spark.read.schema(schema).parquet(kept).where(F.col("batch").isin(batches)).drop("batch")
            audit = whole.withColumn("status", F.lit("complete"))
            upsert_table(clean(raw_rows(complete_only(pages, audit)), t, keep=(*LINEAGE, "pos")), path, t)

        # The batch may be run again: what the state before it names stays.
        needed = before.where("kind = 'page'").agg(F.min("batch")).first()[0]
        oldest = batch_id if needed is None else min(needed, batch_id)
        for folder, number in ((f, int(f.rsplit("=", 1)[-1])) for f in folders(spark, kept) if "batch=" in f):
            if number < oldest:
                remove(spark, folder)
        for folder in folders(spark, f"{landed}/state"):
            if int(folder.rsplit("/", 1)[-1]) < batch_id - 1:
                remove(spark, folder)

    return sink
