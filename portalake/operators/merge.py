"""Keeping typed tables current: keyed upsert and per-period replacement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portalake.schema import Table

# Newest capture wins; within one capture the later row.
RECENCY = ("captured_at", "page", "pos")


def latest_by_key(rows: DataFrame, keys: list[str], recency: tuple[str, ...] = RECENCY) -> DataFrame:
    """The newest row per key. Each task sends one row per key it saw, so a key with a third of
    all versions costs no more than another. Spark sorts for this aggregate, before and after
    the shuffle, as its state is a whole row."""
    rest = [c for c in rows.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*recency)).alias("_row")
    return (rows.groupBy(*keys).agg(newest)
            .select(*[c if c in keys else F.col("_row")[c].alias(c) for c in rows.columns]))


def upsert_by_key(existing: DataFrame, incoming: DataFrame, table: Table,
                  recency: tuple[str, ...] = RECENCY) -> DataFrame:
    """Old and new rows, one per natural key, the newest kept."""
    if table.wide or not table.key_columns:
        raise ValueError(f"{table.full_name} has no natural key: replace it by period")
    return latest_by_key(existing.unionByName(incoming), table.key_columns, recency)


def replace_periods(existing: DataFrame, incoming: DataFrame, period: list[str]) -> DataFrame:
    """New rows plus the old rows of periods the new rows do not cover. Only the distinct
    periods of the new rows meet the old table."""
    covered = incoming.select(*period).distinct()
    same = [existing[c].eqNullSafe(covered[c]) for c in period]
    return existing.join(covered, same, "left_anti").unionByName(incoming)


def with_row_id(rows: DataFrame, name: str = "row_id") -> DataFrame:
    """Surrogate id of a wide table's row: where it came from. Unlike a hash it is unique at
    any size, and a re-run gives the same id. A missing part is written ``?``."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("?")) for c in ("capture_id", "page", "pos")]
    return rows.withColumn(name, F.concat_ws(":", *parts))
