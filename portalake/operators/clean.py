"""Vendor rows -> typed rows of one table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portalake.functions.parsers import BY_KIND, out_of_range, perhaps_large
from portalake.schema import Field, Table


def tidied(field: Field, table: Table, raw: Column) -> Column:
    """The tidied text of a token; one that is derived comes out tidy."""
    derive = table.derived.get(field.token)
    return derive(raw) if derive else BY_KIND[field.kind].tidy(raw[field.token])


#: Columns that one generated method types at a speed the JVM will compile.
NARROW = 8


def _apart(value: Column) -> Column:
    """The same value, by an expression that is left out of whole-stage code. Spark then generates
    its projection by itself, in methods small enough to be compiled, whatever the session's limit
    for generated methods is; of a wide table they would be one that is interpreted."""
    return F.element_at(F.transform(F.array(value), lambda x: x), 1)


def _typed(field: Field, apart: bool = False) -> Column:
    value = BY_KIND[field.kind].read(F.col(f"_{field.column}"))
    return (_apart(value) if apart else value).alias(field.column, metadata=field.struct_field.metadata)


def _projected(rows: DataFrame, table: Table, keep: tuple[str, ...], raw: str) -> DataFrame:
    """Kept and typed columns, and the tidied text of whole numbers beside them."""
    tidy = [tidied(f, table, F.col(raw)).alias(f"_{f.column}") for f in table.fields]
    text = [F.col(f"_{f.column}") for f in _whole_numbers(table)]
    # One such column takes its whole projection out; the last is the least likely to be filtered by.
    wide = len(table.fields) > NARROW
    typed = [_typed(f, wide and f is table.fields[-1]) for f in table.fields]
    return rows.select(*keep, *tidy).select(*keep, *typed, *text)


def project(rows: DataFrame, table: Table, keep: tuple[str, ...] = (),
            raw: str = "raw") -> DataFrame:
    """Rename and type the declared tokens, in declared order; other tokens are dropped.
    ``keep`` names lineage columns to carry along."""
    return _projected(rows, table, keep, raw).select(*keep, *table.columns)


def _all_present(table: Table) -> Column:
    return reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in table.required_columns),
                  F.lit(True))


def _whole_numbers(table: Table) -> list[Field]:
    return [f for f in table.fields if f.kind in ("int", "whole")]


def _too_large(table: Table) -> Column:
    """The first column whose whole number was not read for its size. Texts of those that came out
    NULL are put in one array, so that wide tables don't repeat the test in generated code for
    each column, and only in rows where one of them is long enough."""
    fields = _whole_numbers(table)
    if not fields:
        return F.lit(None).cast("string")
    unread = F.array(*[F.struct(F.lit(f.column).alias("column"), F.when(F.col(f.column).isNull(), F.col(f"_{f.column}")).alias("text")) for f in fields])
    perhaps = reduce(lambda a, b: a | b, (F.col(f.column).isNull() & F.coalesce(perhaps_large(F.col(f"_{f.column}")), F.lit(False)) for f in fields))
    return F.when(perhaps, F.get(F.filter(unread, lambda x: out_of_range(x["text"])), F.lit(0))["column"])


def clean(rows: DataFrame, table: Table, keep: tuple[str, ...] = (),
          raw: str = "raw") -> DataFrame:
    """Typed rows that have their dates and, unless the table is wide, all key parts. A whole
    number past its column (64 bits, or 38 digits where the table is ``exact``) is NULL here;
    :func:`rejects` names the row."""
    typed = project(rows, table, keep, raw)
    return typed.where(_all_present(table)) if table.required_columns else typed


def rejects(rows: DataFrame, table: Table, keep: tuple[str, ...] = (),
            raw: str = "raw") -> DataFrame:
    """The rows :func:`clean` leaves out, ``reason`` being ``missing``, and those of which it could
    not keep a whole number, ``out of range``; ``missing`` names the first column that is so."""
    lacking = F.coalesce(*[F.when(F.col(c).isNull(), c) for c in table.required_columns],
                         F.lit(None).cast("string"))
    found = _projected(rows, table, keep, raw).select(*keep, *table.columns, _too_large(table).alias("_large"), lacking.alias("_lacking"))
    return (found.where(F.col("_large").isNotNull() | F.col("_lacking").isNotNull())
            .select(*keep, *table.columns, F.coalesce("_large", "_lacking").alias("missing"),
                    F.when(F.col("_large").isNotNull(), "out of range").otherwise("missing").alias("reason")))
