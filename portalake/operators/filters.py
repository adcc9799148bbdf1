"""The request filters of each service, as predicates on typed rows.

Bounds are checked on the driver and compared as ISO text, which sorts like the date, so a
typed parquet table prunes on them. Range ends are inclusive; ``None`` leaves an end open. Of a
stored table, which has a month column, only the months are opened that the request names.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portalake.schema import PERIOD, Table

# Closed vocabularies of the portal.
TERMS = {"DAILY": "1 day", "MONTH": "1 month", "3MONTH": "3 months"}
BASES = {"1": "notice_at", "2": "opening_at"}


def _digits(value: str, lengths: tuple[int, ...], name: str) -> str:
    if not re.fullmatch("[0-9]+", value) or len(value) not in lengths:
        raise ValueError(f"{name} must have {' or '.join(map(str, lengths))} digits: {value!r}")
    return value


def _choice(value: str, allowed: dict[str, str], name: str) -> str:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {list(allowed)}: {value!r}")
    return allowed[value]


def _within(column: Column, low: str | Column | None, high: str | Column | None) -> Column:
    test = F.lit(True)
    if low is not None:
        test = test & (column >= low)
    if high is not None:
        test = test & (column <= high)
    return test


def in_months(df: DataFrame, first: str | Column | None = None, last: str | Column | None = None) -> DataFrame:
    """Of a stored table the months ``first`` to ``last`` (``yyyy-MM``); other rows are not filtered."""
    return df.where(_within(F.col(PERIOD), first, last)) if PERIOD in df.columns else df


def date_range(df: DataFrame, table: Table, begin: str | None = None,
               end: str | None = None) -> DataFrame:
    """Rows dated ``begin`` to ``end`` (``yyyyMMdd`` or ``yyyyMM``). A monthly table uses the
    month of a bound; a table without a date is not filtered."""
    field = table.date_field
    if field is None:
        return df

    def iso(bound: str | None, name: str) -> str | None:
        if bound is None:
            return None
        _digits(bound, (6, 8), name)
        month = f"{bound[:4]}-{bound[4:6]}"
        if field.kind == "date_ym":
            return month
        if len(bound) == 8:
            return f"{month}-{bound[6:]}"
        return f"{month}-01" if name == "begin" else f"{month}-31"

    low, high = iso(begin, "begin"), iso(end, "end")
    df = in_months(df, low and low[:7], high and high[:7])
    return df.where(_within(F.col(field.column), low, high))


def in_year(df: DataFrame, year: int, month: int | None = None,
            column: str = "date") -> DataFrame:
    """Rows of one year, or one month of it."""
    prefix = f"{year:04d}-" if month is None else f"{year:04d}-{month:02d}-"
    first, last = (1, 12) if month is None else (month, month)
    df = in_months(df, f"{year:04d}-{first:02d}", f"{year:04d}-{last:02d}")
    return df.where(F.col(column).startswith(prefix))


def deals(df: DataFrame, region_code: str, deal_ym: str) -> DataFrame:
    """Contracts of one region and contract month (``yyyyMM``)."""
    _digits(deal_ym, (6,), "deal_ym")
    month = f"{deal_ym[:4]}-{deal_ym[4:]}"
    return in_months(df, month, month).where((F.col("region_code") == region_code) & F.col("deal_date").startswith(f"{month}-"))


def bids_in_window(df: DataFrame, begin: str, end: str, basis: str = "1") -> DataFrame:
    """Bids noticed (basis ``1``) or opened (``2``) within minutes ``yyyyMMddHHmm``. A stored table has
    the months of the notices, so a window of openings opens all of them."""
    column = _choice(basis, BASES, "basis")

    def minute(v: str, name: str) -> str:
        _digits(v, (12,), name)
        return f"{v[:4]}-{v[4:6]}-{v[6:8]} {v[8:10]}:{v[10:]}"

    low, high = minute(begin, "begin"), minute(end, "end")
    if basis == "1":
        df = in_months(df, low[:7], high[:7])
    # Values may carry seconds: those of the last minute still belong to it.
    return df.where(_within(F.col(column), low, high + ":59"))


def station_term(df: DataFrame, as_of: Column, term: str = "DAILY",
                 station: str | None = None) -> DataFrame:
    """Measurements of the calendar term up to ``as_of`` (TIMESTAMP_NTZ or TIMESTAMP), of one
    station or of all. ``measured_at`` is ``yyyy-MM-dd HH:mm`` text."""
    since = as_of - F.expr(f"interval {_choice(term, TERMS, 'term')}")
    pattern = "yyyy-MM-dd HH:mm"
    test = F.col("measured_at").between(F.date_format(since, pattern), F.date_format(as_of, pattern))
    df = in_months(df, F.date_format(since, "yyyy-MM"), F.date_format(as_of, "yyyy-MM"))
    return df.where(test if station is None else test & (F.col("station") == station))


def grid_forecast(df: DataFrame, nx: int, ny: int, base_date: str | Column | None = None,
                  base_time: str | Column | None = None) -> DataFrame:
    """Rows of one grid cell and announcement (``yyyyMMdd``, ``HHmm``). Give both parts of the
    announcement or neither."""
    df = df.where((F.col("nx") == nx) & (F.col("ny") == ny))
    if base_date is None and base_time is None:
        return df
    if base_date is None or base_time is None:
        raise ValueError("give both base_date and base_time, or neither")
    if isinstance(base_date, str):
        _digits(base_date, (8,), "base_date")
        day = F.lit(f"{base_date[:4]}-{base_date[4:6]}-{base_date[6:]}")
    else:
        day = F.concat_ws("-", F.substring(base_date, 1, 4), F.substring(base_date, 5, 2),
                          F.substring(base_date, 7, 2))
    month = F.substring(day, 1, 7)
    return in_months(df, month, month).where((F.col("base_date") == day) & (F.col("base_time") == base_time))


def trade_by_hs(df: DataFrame, hs_code: str, prefix: bool = False) -> DataFrame:
    """Rows of one trade code; with ``prefix`` also of the finer codes below it."""
    code = F.col("hs_code")
    return df.where(code.startswith(hs_code) if prefix else code == hs_code)
