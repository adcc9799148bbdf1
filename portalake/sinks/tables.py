"""Typed tables on parquet, laid out by month so that a refresh rewrites only months it
touches, and within a month by what requests ask for, so that a read of one region or cell
passes over the rest."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from portalake.operators.merge import latest_by_key, replace_periods, RECENCY, with_row_id
from portalake.schema import PERIOD, Table
from portalake.session import exists, remove, settle, tidied

# The month of a request parameter that the caller names instead of the table's own period. It is
# another column, as filters take PERIOD for the month of the rows' own dates.
ASKED_PERIOD = "asked_month"
# What a replacement covers in time: a date, an announcement or a month.
REPLACED = "replaced_period"


def _period(table: Table, period_param: str | None) -> Column:
    """The period of a row as text: a request parameter asked for here, the row's date, or the
    table's own column or parameter; rows without one have the day they were captured."""
    if period_param:
        return F.col("params")[period_param]
    captured = F.date_format("captured_at", "yyyy-MM-dd")
    if table.date_column:
        return F.col(table.date_column)
    if table.period_column:
        return F.coalesce(F.col(table.period_column), captured)
    return F.coalesce(F.col("params")[table.period_param], captured) if table.period_param else captured


def _month_of(digits: Column) -> Column:
    return F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 2))


def month_column(rows: DataFrame) -> str:
    """The column that rows are laid out by."""
    return ASKED_PERIOD if ASKED_PERIOD in rows.columns else PERIOD


def with_period(rows: DataFrame, table: Table, period_param: str | None = None) -> DataFrame:
    """Add the partition column, a month, and for a wide table the period a request replaces. A
    row without a period fails the job: stored under none, it would be replaced with rows it
    has nothing to do with."""
    digits = F.regexp_replace(_period(table, period_param), "[^0-9]", "")
    known = F.length(digits) >= 6
    name = ASKED_PERIOD if period_param and period_param != table.period_param else PERIOD
    rows = rows.withColumn(name, F.when(known, _month_of(digits)).otherwise(
        F.raise_error(F.lit(f"a row of {table.full_name} has no period"))))
    return rows.withColumn(REPLACED, F.substring(digits, 1, 6) if table.monthly else digits) if table.wide else rows


def _touched(rows: DataFrame) -> list[str]:
    """The months of some rows: as many as the calendar has."""
    return [r[0] for r in rows.select(month_column(rows)).distinct().collect()]


def stored_months(rows: DataFrame, path: str, months: list[str]) -> DataFrame:
    """Of the stored table the given months; they are values in the plan, so that the scan opens
    their folders alone."""
    return read_table(rows, path).where(F.col(month_column(rows)).isin(months))


def clustering(table: Table) -> list[str]:
    """The columns a stored table is ordered by within a month: what requests name first, then the
    rest of the key."""
    first = [c for c in (*table.slices, *table.asks) if c in table.columns]
    return list(dict.fromkeys([*first, *(c for c in table.key_columns if c != table.date_column)]))


# Columns that tell apart the rows of a hot region. The ranges are found in a pass of its own, which
# types no more columns than it needs.
TOLD_BY = 4


def _spread(rows: DataFrame, ordered: list[str]) -> Column:
    """A hash of some plain columns that rows are not ordered by."""
    plain = [f.name for f in rows.schema.fields if isinstance(f.dataType, AtomicType) and f.name not in ordered]
    return F.xxhash64(*(plain[:TOLD_BY] or ordered))


def write_table(rows: DataFrame, path: str, mode: str = "overwrite", table: Table | None = None,
                options: Mapping[str, str] | None = None) -> None:
    """Write rows by period; the named periods are replaced, others stay.

    Without ``table`` the rebalance hint merges small periods' files and splits a hot period over
    several tasks. With it rows are dealt by ranges of month and the columns requests name, and
    stand in that order, so that a file and each of its row groups hold few regions or cells; the
    rest of the key is part of the ranges and a hash of a few more columns ends them, so that a hot region is
    split too, even where nothing else tells its rows apart. Bloom filters tell
    whether a row group holds a value at all.
    """
    month = month_column(rows)
    order = [] if table is None else [c for c in clustering(table) if c in rows.columns]
    if order:
        rest = [c for c in (table.date_column, "capture_id", "page", "pos") if c and c in rows.columns]
        laid = rows.repartitionByRange(month, *order, *rest, _spread(rows, [month, REPLACED, "captured_at", *order, *rest])).sortWithinPartitions(month, *order, *rest)
    else:
        laid = rows.hint("rebalance", month)
    writer = laid.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(month)
    kinds = {f.column: f.kind for f in table.fields} if order else {}
    for c in order:
        if kinds.get(c) in ("text", "int"):
            writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    writer.parquet(path)


def read_table(rows: DataFrame, path: str) -> DataFrame:
    """The stored table with the schema of ``rows`` (empty before the first write)."""
    spark = rows.sparkSession
    if not exists(spark, path):
        return rows.limit(0)
    return spark.read.schema(rows.schema).parquet(path)


def upsert_table(incoming: DataFrame, path: str, table: Table,
                 recency: tuple[str, ...] = RECENCY) -> None:
    """Merge rows into a stored keyed table. A date is part of every natural key, so only the
    months present in the new rows are read back and rewritten."""
    if table.wide or not table.key_columns:
        raise ValueError(f"{table.full_name} has no natural key: use replace_table")

    def run() -> None:
        rows = settle(with_period(incoming, table))
        months = _touched(rows)
        if months:
            stored = stored_months(rows, path, months)
            write_table(latest_by_key(stored.unionByName(rows), table.key_columns, recency), path, table=table)

    tidied(run, incoming.sparkSession)


def _covered_months(covered: DataFrame, month: str) -> DataFrame:
    """A row of coverage for each month of it."""
    first, last = (F.to_date(F.substring(c, 1, 6), "yyyyMM") for c in ("first", "last"))
    months = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month")))
    return covered.withColumn(month, F.explode(F.transform(months, lambda d: F.date_format(d, "yyyy-MM"))))


def _outside(rows: DataFrame, covered: DataFrame, table: Table, newer: bool = False) -> DataFrame:
    """The rows that no coverage (by month) includes; with ``newer``, none of another fetch that began
    after the row was captured."""
    month = month_column(rows)
    names = [c for c in table.asks if c in rows.columns]
    same = rows[month] == covered[month]
    for c in names:
        same &= rows[c].cast("string") == covered[c]
    period = rows[REPLACED]
    n = F.least(F.length(covered["first"]), F.length(period))
    m = F.least(F.length(covered["last"]), F.length(period))
    same &= F.substring(period, F.lit(1), n) >= F.substring(covered["first"], F.lit(1), n)
    same &= F.substring(period, F.lit(1), m) <= F.substring(covered["last"], F.lit(1), m)
    if newer:
        same &= (rows["capture_id"] != covered["capture_id"]) & (rows["captured_at"] < covered["began"])
    return rows.join(covered, same, "left_anti")


def replace_table(incoming: DataFrame, path: str, table: Table, period_param: str | None = None,
                  slices: list[str] | None = None, covered: DataFrame | None = None) -> None:
    """Replace a wide table's rows as far as the new rows cover them, with surrogate ids: the rows
    of the same period and the same ``slices``, by default those the table declares (such as the
    region or the grid cell asked for). All else in a month stays.

    ``covered`` (of ``requests.coverage``) names besides what complete fetches asked for: stored rows of
    those periods, regions and cells go even if no new row took their place, and so do new rows
    that a later fetch of the same did not find any more. A month that nothing is left of is
    removed.
    """
    tidied(lambda: _replace_table(incoming, path, table, period_param, slices, covered), incoming.sparkSession)


def _replace_table(incoming: DataFrame, path: str, table: Table, period_param: str | None, slices: list[str] | None,
                   covered: DataFrame | None) -> None:
    incoming = with_row_id(with_period(incoming, table, period_param))
    month = month_column(incoming)
    if covered is not None and month == PERIOD:
        covered = settle(_covered_months(covered, month), "covered")
        incoming = settle(_outside(incoming, covered, table, newer=True))
        emptied = set(_touched(covered))
    else:
        incoming, covered, emptied = settle(incoming), None, set()
    filled = set(_touched(incoming))
    if not filled | emptied:
        return
    of = [month, REPLACED, *(table.slices if slices is None else slices)]
    stored = stored_months(incoming, path, sorted(filled | emptied))
    if covered is not None:
        stored = _outside(stored, covered, table)
    merged = replace_periods(stored, incoming, of)
    left = filled | {r[0] for r in stored.where(F.col(month).isin(sorted(emptied - filled))).select(month).distinct().collect()}
    if left:
        write_table(merged, path, table=table)
    for gone in sorted(emptied - left):
        remove(incoming.sparkSession, f"{path.rstrip('/')}/{month}={gone}")


def rows_to_json(rows: DataFrame) -> DataFrame:
    """Each row as one JSON text, NULLs written out, non-ASCII kept."""
    return rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("json"))


def write_json(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Rows as JSON lines."""
    rows.write.mode(mode).option("ignoreNullFields", "false").json(path)
