"""What a request asks for, as conditions on captures and on vendor rows before they are typed;
and what captures cover, by the parameters they were asked with.

A condition on captures rules out those whose own parameters show that they hold nothing of what
is asked; a capture without parameters is not ruled out. One on rows is only a first sieve: the
service's filter on typed rows follows.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portalake.functions.parsers import BY_KIND
from portalake.operators.clean import tidied
from portalake.schema import Table


@dataclass(frozen=True)
class Request:
    """One value for some columns, exact request parameters, and a first and last period as digits
    of any length from a year to a minute; a value may be a Column of constants."""

    equal: Mapping[str, object] = field(default_factory=dict)
    params: Mapping[str, str] = field(default_factory=dict)
    first: str | Column | None = None
    last: str | Column | None = None


def _literal(value: object) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _all(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def _not_after(a: Column, b: Column) -> Column:
    """Whether period a begins no later than period b ends, as far as both are given."""
    n = F.least(F.length(a), F.length(b))
    return F.substring(a, F.lit(1), n) <= F.substring(b, F.lit(1), n)


def of_captures(table: Table, request: Request, captured: tuple[str | None, str | None] = (None, None)) -> Column:
    """Captures that may hold rows of the request, taken between two times (inclusive)."""
    params = F.col("params")
    tests = [F.col("captured_at") >= F.lit(captured[0]).cast("timestamp")] if captured[0] else []
    tests += [F.col("captured_at") <= F.lit(captured[1]).cast("timestamp")] if captured[1] else []
    tests += [params[token] == value for token, value in request.params.items()]
    for column, value in request.equal.items():
        if token := table.asks.get(column):
            tests.append(params[token].isNull() | (params[token] == _literal(value).cast("string")))
    if table.span:
        first, last = table.span(params)
        if request.last is not None:
            tests.append(first.isNull() | _not_after(first, _literal(request.last)))
        if request.first is not None:
            tests.append(last.isNull() | _not_after(_literal(request.first), last))
    return _all(tests)


def _typed(table: Table, column: str, row: Column) -> Column:
    f = next(f for f in table.fields if f.column == column)
    return BY_KIND[f.kind].read(tidied(f, table, row))


def of_rows(table: Table, request: Request, row: Column) -> Column | None:
    """Vendor rows (``row``, a struct of declared tokens) that may belong to the request; None if
    nothing can be told from them."""
    tests = [_typed(table, c, row) == _literal(v) for c, v in request.equal.items() if c in table.columns]
    if table.date_column and (request.first is not None or request.last is not None):
        date = F.replace(_typed(table, table.date_column, row), F.lit("-"), F.lit(""))
        tests += [_not_after(_literal(request.first), date)] if request.first is not None else []
        tests += [_not_after(date, _literal(request.last))] if request.last is not None else []
    return _all(tests) if tests else None


def coverage(complete: DataFrame, table: Table) -> DataFrame:
    """What complete captures cover, their rows or their lack of rows aside: ``capture_id``, ``first`` and
    ``last`` period (digits), the columns of ``table.asks``, and when the fetch ``began``. ``complete`` has
    the pages of complete captures. Those whose parameters don't name all of these cover nothing
    here, nor do those of a table that isn't asked for by period."""
    params = F.col("params")
    first, last = table.span(params) if table.span else (F.lit(None).cast("string"),) * 2
    digits = lambda c: F.regexp_replace(c, "[^0-9]", "")
    named = {"first": digits(first), "last": digits(last)} | {c: params[token] for c, token in table.asks.items()}
    found = complete.select("capture_id", "captured_at", *(v.alias(c) for c, v in named.items()))
    return (found.dropna(subset=list(named)).where((F.length("first") >= 6) & (F.length("last") >= 6))
            .groupBy("capture_id", *named).agg(F.min("captured_at").alias("began")))
