"""From landed captures to one dataset."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portalake.functions.announcements import latest_announcement
from portalake.operators import filters
from portalake.operators.audit import complete_only, page_audit, refused
from portalake.operators.clean import clean as clean_rows
from portalake.operators.clean import rejects as reject_rows
from portalake.operators.requests import Request, coverage, of_captures, of_rows
from portalake.schema import Table
from portalake.session import shared_folder, tidied
from portalake.sinks.tables import replace_table, upsert_table
from portalake.sources.envelope import LINEAGE, parse_pages, raw_rows, sift_rows, stage_pages
from portalake.sources.pages import layer_pages
from portalake.tables import table as find_table

ROW_LINEAGE = (*LINEAGE, "pos")


def _of_operation(captures: DataFrame, table: Table) -> DataFrame:
    # Both are partition columns of a stored captures table: other tables are not opened.
    return captures.where((F.col("service") == table.service)
                          & (F.col("operation") == table.operation))


def _complete_rows(pages: DataFrame, stage: str | None) -> DataFrame:
    """Rows of complete fetches. Pages are parsed once: they are written to ``stage`` (a folder
    that the cluster shares; by default the session's), and the audit and the rows read that."""
    pages = stage_pages(pages, stage or shared_folder(pages.sparkSession))
    return raw_rows(complete_only(pages, page_audit(pages)))


def _asked_rows(captures: DataFrame, table: Table, request: Request, stage: str | None, pages: str | None,
                captured: tuple[str | None, str | None]) -> DataFrame:
    """Vendor rows of complete fetches that may belong to a request. Captures whose parameters rule
    them out are not parsed. With ``pages``, a folder that lasts, bodies parsed before aren't
    parsed again; without, pages are staged for this call with the rows that may be asked for."""
    which = of_captures(table, request, captured)
    if pages is not None:
        held = layer_pages(captures, pages, table, which, captured)
        return raw_rows(complete_only(held, page_audit(held)))
    parsed = parse_pages(_of_operation(captures, table).where(which), table)
    if of_rows(table, request, F.col("items")[0]) is not None:
        parsed = sift_rows(parsed, lambda r: of_rows(table, request, r))
    return _complete_rows(parsed, stage)


def generic_rows(captures: DataFrame, service: str, operation: str, secret: str | None = None,
                 stage: str | None = None) -> DataFrame:
    """Vendor rows (``raw`` MAP) of any operation, declared or not, from complete fetches."""
    chosen = captures.where((F.col("service") == service) & (F.col("operation") == operation))
    return _complete_rows(parse_pages(chosen, secret=secret), stage)


def vendor_rows(captures: DataFrame, name: str, stage: str | None = None) -> DataFrame:
    """Unchanged vendor rows of a declared table."""
    t = find_table(name)
    return generic_rows(captures, t.service, t.operation, stage=stage)


def typed_rows(captures: DataFrame, name: str, keep: tuple[str, ...] = (),
               stage: str | None = None, pages: str | None = None) -> DataFrame:
    """Typed rows of a declared table from complete fetches. Parsed pages are written once, below
    ``stage`` or the session's shared folder; or kept below ``pages``, where every body is parsed
    once, however often it is asked for."""
    t = find_table(name)
    return clean_rows(_asked_rows(captures, t, Request(), stage, pages, (None, None)), t, keep)


def rejected_rows(captures: DataFrame, name: str, keep: tuple[str, ...] = ROW_LINEAGE,
                  stage: str | None = None) -> DataFrame:
    """Rows of complete fetches that lack a date or a key part."""
    t = find_table(name)
    pages = parse_pages(_of_operation(captures, t), t)
    return reject_rows(_complete_rows(pages, stage), t, keep)


def refused_fetches(captures: DataFrame, secret: str | None = None) -> DataFrame:
    """Fetches that yield no rows, with status and message."""
    return refused(page_audit(parse_pages(captures, secret=secret)))


def empty_fetches(captures: DataFrame) -> DataFrame:
    """Fetches that are complete and have no rows: no data, or a wrong code was asked for."""
    audit = page_audit(parse_pages(captures))
    return audit.where((F.col("status") == "complete") & (F.col("rows") == 0))


def _asked(token: str, value: str) -> Column:
    return F.col("params")[token] == value


def _weather(df: DataFrame, t: Table, *, nx: int, ny: int, base_date: str | None = None,
             base_time: str | None = None, now: Column | None = None) -> DataFrame:
    if base_date is None and base_time is None:
        latest = _latest(t, now)
        return filters.grid_forecast(df, nx, ny, latest["base_date"], latest["base_time"])
    return filters.grid_forecast(df, nx, ny, base_date, base_time)


def _airquality(df: DataFrame, t: Table, *, sido: str | None = None, station: str | None = None,
                data_term: str | None = None, as_of: Column | None = None,
                ver: str | None = None) -> DataFrame:
    if ver is not None:
        df = df.where(_asked("ver", ver))
    if t.name == "by_sido":
        return df if sido is None else df.where(F.col("sido") == sido)
    if data_term is not None and as_of is not None:
        return filters.station_term(df, as_of, data_term, station)
    if data_term is not None:
        if data_term not in filters.TERMS:
            raise ValueError(f"data_term must be one of {list(filters.TERMS)}")
        df = df.where(_asked("dataTerm", data_term))
    return df if station is None else df.where(F.col("station") == station)


def _holidays(df: DataFrame, t: Table, *, year: int, month: int | None = None) -> DataFrame:
    return filters.in_year(df, year, month)


def _realestate(df: DataFrame, t: Table, *, region_code: str, deal_ym: str) -> DataFrame:
    return filters.deals(df, region_code, deal_ym)


def _midforecast(df: DataFrame, t: Table, *, region_code: str, base_time: str) -> DataFrame:
    month = f"{base_time[:4]}-{base_time[4:6]}"
    return filters.in_months(df, month, month).where((F.col("region_code") == region_code) & _asked("tmFc", base_time))


def _procurement(df: DataFrame, t: Table, *, begin: str, end: str,
                 query_basis: str = "1") -> DataFrame:
    return filters.bids_in_window(df, begin, end, query_basis)


def _customs(df: DataFrame, t: Table, *, hs_code: str, begin: str, end: str,
             prefix: bool = False) -> DataFrame:
    return filters.trade_by_hs(filters.date_range(df, t, begin, end), hs_code, prefix)


def _kofia(df: DataFrame, t: Table, *, begin: str | None = None,
           end: str | None = None) -> DataFrame:
    return filters.date_range(df, t, begin, end)


def refresh_table(captures: DataFrame, name: str, path: str, stage: str | None = None, pages: str | None = None) -> None:
    """Bring a stored table up to date with captures: a keyed one is merged, a wide one replaced as far
    as complete fetches cover it by their request parameters, also where they found nothing, and
    by the rows they found. What is stored on the way is deleted, kept ``pages`` aside."""
    t = find_table(name)

    def run() -> None:
        if pages is not None:
            held = layer_pages(captures, pages, t)
        else:
            held = stage_pages(parse_pages(_of_operation(captures, t), t), stage or shared_folder(captures.sparkSession))
        good = complete_only(held, page_audit(held))
        rows = clean_rows(raw_rows(good), t, ROW_LINEAGE)
        if t.wide:
            replace_table(rows, path, t, covered=coverage(good, t))
        else:
            upsert_table(rows, path, t)

    tidied(run, captures.sparkSession)


def _latest(t: Table, now: Column | None) -> Column:
    return latest_announcement(F.current_timestamp() if now is None else now, t.name)


# What each service's arguments ask for. Arguments are as those of the filters above.

def _ask_weather(t: Table, *, nx: int, ny: int, base_date: str | None = None, base_time: str | None = None,
                 now: Column | None = None) -> Request:
    if base_date is None and base_time is None:
        latest = _latest(t, now)
        base_date, base_time = latest["base_date"], latest["base_time"]
    return Request({"nx": nx, "ny": ny, "base_time": base_time}, first=base_date, last=base_date)


def _ask_airquality(t: Table, *, sido: str | None = None, station: str | None = None, data_term: str | None = None,
                    as_of: Column | None = None, ver: str | None = None) -> Request:
    params = {} if ver is None else {"ver": ver}
    if t.name == "by_station" and data_term is not None and as_of is None:
        params["dataTerm"] = data_term
    column, value = ("sido", sido) if t.name == "by_sido" else ("station", station)
    return Request({} if value is None else {column: value}, params)


def _ask_holidays(t: Table, *, year: int, month: int | None = None) -> Request:
    period = f"{year:04d}" if month is None else f"{year:04d}{month:02d}"
    return Request(first=period, last=period)


def _ask_realestate(t: Table, *, region_code: str, deal_ym: str) -> Request:
    return Request({"region_code": region_code}, first=deal_ym, last=deal_ym)


def _ask_midforecast(t: Table, *, region_code: str, base_time: str) -> Request:
    return Request({"region_code": region_code}, {"tmFc": base_time})


def _ask_procurement(t: Table, *, begin: str, end: str, query_basis: str = "1") -> Request:
    return Request(first=begin, last=end) if query_basis == "1" else Request()


def _ask_customs(t: Table, *, hs_code: str, begin: str, end: str, prefix: bool = False) -> Request:
    return Request({} if prefix else {"hs_code": hs_code}, first=begin, last=end)


def _ask_kofia(t: Table, *, begin: str | None = None, end: str | None = None) -> Request:
    return Request(first=begin, last=end)


_FILTERS: dict[str, Callable[..., DataFrame]] = {
    "weather": _weather, "airquality": _airquality, "holidays": _holidays,
    "realestate": _realestate, "midforecast": _midforecast, "procurement": _procurement,
    "customs": _customs, "kofia": _kofia,
}
_REQUESTS: dict[str, Callable[..., Request]] = {
    "weather": _ask_weather, "airquality": _ask_airquality, "holidays": _ask_holidays,
    "realestate": _ask_realestate, "midforecast": _ask_midforecast, "procurement": _ask_procurement,
    "customs": _ask_customs, "kofia": _ask_kofia,
}


def select_rows(rows: DataFrame, name: str, **arguments) -> DataFrame:
    """Apply a service's request filters to typed rows (which carry ``params``, or are a
    stored table with the columns the filter needs)."""
    t = find_table(name)
    return _FILTERS[t.service](rows, t, **arguments)


def fetch(captures: DataFrame, name: str, stage: str | None = None, pages: str | None = None,
          captured: tuple[str | None, str | None] = (None, None), **arguments) -> DataFrame:
    """The table's typed columns for one request, such as
    ``fetch(captures, "weather.forecast", nx=60, ny=127)``.

    Captures whose request parameters show that they hold nothing of it are not parsed, nor are
    those taken outside ``captured`` (first and last time). Of the others only rows that may be
    asked for are staged, below ``stage``. With ``pages``, a folder that lasts, whole pages are kept
    there instead, and a body that any earlier call has parsed is not parsed again.
    """
    t = find_table(name)
    request = _REQUESTS[t.service](t, **arguments)
    rows = clean_rows(_asked_rows(captures, t, request, stage, pages, captured), t, ("params",))
    return select_rows(rows, name, **arguments).select(*t.columns)
