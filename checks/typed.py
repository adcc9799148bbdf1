"""Parsers, the declared tables, cleaning and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import untidy
from checks.registry import Query, add, query, raw_from
from checks.untidy import LINEITEM, ORDERS, read
from portalake import TABLES, clean, project, rejects, table
from portalake.functions import parsers
from portalake.operators import filters
from portalake.schema import Field, Table

for _kind, _source, _j in (("date_ymd", LINEITEM, 0), ("date_ym", LINEITEM, 1), ("text", LINEITEM, 3),
                           ("int", LINEITEM, 4), ("ratio", LINEITEM, 1), ("decimal", ORDERS, 0)):
    add(f"parse_{_kind}", *untidy.field_query(Field("t", "v", _kind), _source, _j))


def _source_of(t: Table) -> untidy.Source:
    return LINEITEM if t.service in ("kofia", "customs", "realestate") else ORDERS


def _typed(t: Table) -> Query:
    return lambda spark, sf_dir: clean(untidy.vendor_rows(spark, sf_dir, t, _source_of(t)), t)


for _t in TABLES.values():
    add(_t.full_name.replace(".", "_"), _typed(_t), untidy.clean_sql(_t, _source_of(_t)))


FUNDS, TRADE, DEALS = table("kofia.market_funds"), table("customs.item_trade"), table("realestate.apt_trade")
CMA, OVERSEAS = table("kofia.cma_status"), table("kofia.overseas_derivatives")


@query("clean_project", untidy.project_sql(FUNDS, LINEITEM))
def _(spark, sf_dir):
    return project(untidy.vendor_rows(spark, sf_dir, FUNDS, LINEITEM), FUNDS)


@query("clean_composite", untidy.clean_sql(TRADE, ORDERS))
def _(spark, sf_dir):
    return clean(untidy.vendor_rows(spark, sf_dir, TRADE, ORDERS), TRADE)


@query("clean_wide", untidy.clean_sql(OVERSEAS, ORDERS))
def _(spark, sf_dir):
    return clean(untidy.vendor_rows(spark, sf_dir, OVERSEAS, ORDERS), OVERSEAS)


@query("clean_rejects", untidy.rejects_sql(CMA, ORDERS))
def _(spark, sf_dir):
    return rejects(untidy.vendor_rows(spark, sf_dir, CMA, ORDERS), CMA)


@query("rejects_out_of_range", """
    select o_orderkey as k, 'hs_code' as missing, 'missing' as reason
    from orders where o_orderkey % 3 = 0 and o_orderkey % 5 <> 0
    union all
    select o_orderkey, 'export_usd', 'out of range' from orders where o_orderkey % 5 = 0""")
def _(spark, sf_dir):
    t = table("customs.item_trade")
    rows = raw_from(read(spark, sf_dir, "orders"), key="o_orderkey", year="'2024.01'",
                    hsCode="if(o_orderkey % 3 = 0, ' ', o_orderstatus)",
                    expDlr="if(o_orderkey % 5 = 0, concat(o_orderkey, '99,999,999,999,999,999,999'), cast(o_orderkey as string))")
    return rejects(rows, t, keep=("k",)).select("k", "missing", "reason")


_DEAL_DATE = untidy.expected("o_orderdate", "date_ymd", untidy.pick("o_orderkey", 0))


@query("deal_date", f"select o_orderkey as k, {_DEAL_DATE} as deal_date from orders")
def _(spark, sf_dir):
    rows = untidy.vendor_rows(spark, sf_dir, DEALS, ORDERS)
    return rows.select("k", parsers.date_ymd(parsers.deal_date(F.col("raw"))).alias("deal_date"))


def _filtered(name: str, t: Table, sql_where: str, apply) -> None:
    source = _source_of(t)
    add(name, lambda spark, sf_dir: apply(clean(untidy.vendor_rows(spark, sf_dir, t, source), t)),
        untidy.clean_sql(t, source, sql_where))


CREDIT, TRUST, HOLIDAYS = table("kofia.credit_balance"), table("kofia.trust_scale"), table("holidays.holidays")
TERMS_OF_SUN, RENT = table("holidays.solar_terms"), table("realestate.apt_rent")

_filtered("date_range_daily", CREDIT, "base_date between '1996-03-01' and '1998-02-28'",
          lambda rows: filters.date_range(rows, CREDIT, "19960301", "19980228"))
_filtered("date_range_monthly", TRUST, "base_ym >= '1997-02'",
          lambda rows: filters.date_range(rows, TRUST, begin="19970215"))
_filtered("holiday_month", HOLIDAYS, """"date" between '1996-07-01' and '1996-07-31'""",
          lambda rows: filters.in_year(rows, 1996, 7))
_filtered("holiday_year", TERMS_OF_SUN, """"date" between '1999-01-01' and '1999-12-31'""",
          lambda rows: filters.in_year(rows, 1999))
_filtered("deals_by_region_month", RENT,
          "region_code = 'O' and deal_date between '1997-05-01' and '1997-05-31'",
          lambda rows: filters.deals(rows, "O", "199705"))
_filtered("trade_by_hs", TRADE, "hs_code = 'O' and period between '1996-01' and '1999-06'",
          lambda rows: filters.trade_by_hs(filters.date_range(rows, TRADE, "199601", "199906"), "O"))
_filtered("trade_by_hs_prefix", TRADE, "left(hs_code, 2) = '1,'",
          lambda rows: filters.trade_by_hs(rows, "1,", prefix=True))


def bid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    noticed = "o_orderdate + make_dt_interval(0, 0, int(o_orderkey % 1440), o_orderkey % 60)"
    text = "date_format({}, 'yyyy-MM-dd HH:mm:ss')"
    return raw_from(read(spark, sf_dir, "orders"), key="o_orderkey", bidNtceNo="o_orderkey",
                    bidNtceOrd="o_orderstatus", bidNtceNm="o_orderpriority",
                    presmptPrce="cast(round(o_totalprice) as bigint)",
                    bidNtceDt=text.format(noticed), opengDt=text.format(noticed + " + interval 30 days"))


BID_COLUMNS = ("notice_no", "notice_ord", "estimated_price_krw", "notice_at", "opening_at")


def bids_sql(column: str, begin: str, end: str) -> str:
    at = ("o_orderdate + to_minutes(cast(o_orderkey % 1440 as int)) "
          "+ to_seconds(cast(o_orderkey % 60 as int))")
    form = "'%Y-%m-%d %H:%M:%S'"
    return f"""
        select notice_no, notice_ord, estimated_price_krw, strftime(noticed, {form}) as notice_at,
               strftime(opened, {form}) as opening_at
        from (select cast(o_orderkey as varchar) as notice_no, o_orderstatus as notice_ord,
                     cast(round(o_totalprice) as bigint) as estimated_price_krw,
                     {at} as noticed, {at} + interval 30 days as opened from orders) as t
        where {column} >= timestamp '{begin}' and {column} < timestamp '{end}'"""


for _name, _basis, _column in (("noticed", "1", "noticed"), ("opened", "2", "opened")):
    add(f"bids_{_name}_in_window",
        lambda spark, sf_dir, basis=_basis: filters.bids_in_window(
            clean(bid_rows(spark, sf_dir), table("procurement.goods")),
            "199603010930", "199804301200", basis).select(*BID_COLUMNS),
        bids_sql(_column, "1996-03-01 09:30", "1998-04-30 12:01"))


def _station_term(term: str, as_of: str, since: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = raw_from(read(spark, sf_dir, "events"), stationName="concat('측정소', user_id)",
                        dataTime="date_format(ts, 'yyyy-MM-dd HH:mm')",
                        pm10Value="cast(floor(value) as bigint)", so2Value="value", pm10Flag="event_type")
        rows = clean(rows, table("airquality.by_station"))
        return (filters.station_term(rows, F.lit(as_of).cast("timestamp_ntz"), term)
                .select("station", "measured_at", "pm10", "so2", "pm10_flag"))

    add(f"station_term_{term.lower()}", run, f"""
        select '측정소' || user_id as station, strftime(ts, '%Y-%m-%d %H:%M') as measured_at,
               cast(floor(value) as bigint) as pm10, value as so2, event_type as pm10_flag
        from events where ts >= timestamp '{since}' and ts < timestamp '{as_of}' + interval 1 minute""")


_station_term("DAILY", "2024-01-15 12:00", "2024-01-14 12:00")
_station_term("MONTH", "2024-02-10 06:30", "2024-01-10 06:30")
_station_term("3MONTH", "2024-04-15 00:00", "2024-01-15 00:00")


GRID_SQL = """
    select '2024-01-05' as base_date, '1700' as base_time, event_type as category,
           '2024-01-06' as forecast_date, strftime(ts, '%H00') as forecast_time,
           cast(value as varchar) as forecast_value, cast(7 as bigint) as nx, cast(127 as bigint) as ny
    from events
    where user_id % 10 = 7 and ts >= timestamp '2024-01-05 12:00' and ts < timestamp '2024-01-06'"""


def grid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_from(read(spark, sf_dir, "events"), key="event_id", baseDate="date_format(ts, 'yyyyMMdd')",
                    baseTime="if(hour(ts) >= 12, '1700', '0500')", category="event_type",
                    fcstDate="date_format(ts + interval 1 day, 'yyyyMMdd')",
                    fcstTime="date_format(ts, 'HH00')", fcstValue="value", nx="user_id % 10", ny="127")


@query("grid_forecast", GRID_SQL)
def _(spark, sf_dir):
    rows = clean(grid_rows(spark, sf_dir), table("weather.forecast"))
    return filters.grid_forecast(rows, 7, 127, "20240105", "1700")
