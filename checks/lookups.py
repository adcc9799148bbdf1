"""Lookups, keyed and per-period merging, and export."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import add, query
from checks.untidy import read
from portalake import (grid_cell, latest_announcement, replace_periods, resolve_land_zone,
                       resolve_named, resolve_region, resolve_temp_city, rows_to_json, table, upsert_by_key,
                       with_row_id)
from portalake.functions.announcements import SCHEDULES
from portalake.functions.text import nfc
from portalake.operators.places import LAND_ZONES, PROVINCE_ALIASES

# A few rows of the public district list, enough for unique, repeated, seam,
# alias and near-miss names.
DISTRICTS = """
강원특별자치도 고성군 51820
경기도 광주시 41610
경기도 수원시 41110
경기도 수원시장안구 41111
경기도 시흥시 41390
경상남도 고성군 48820
경상북도 포항시 47110
경상북도 포항시남구 47111
대구광역시 남구 27200
대구광역시 중구 27110
부산광역시 중구 26110
서울특별시 종로구 11110
서울특별시 중구 11140
세종특별자치시 세종시 36110
울산광역시 중구 31110
충청남도 천안시동남구 44131
충청북도 청주시 43110
충청북도 청주시상당구 43111
"""

# A few rows of the public list of forecast cities.
CITIES = """
가평 11B20404
고성 11D20402
고성 11H20404
고성(장전) 11L10002
광주 11B20702
광주 11F20501
서울 11B10101
순천 11F20603
순천시 11F20405
제주 11G00201
"""

_NFD = {name: unicodedata.normalize("NFD", name) for name in ("종로구", "서울")}
PLACES = ("종로구", "중구", "서울 중구", " 서울특별시　 중구 ", "경남 고성군", "고성군", "장안구",
          "수원시 장안구", "경기도 수원시 장안구", "천안 남구", "남구", "포항시 남구", "충북 상당구",
          "시", "없는군", "", _NFD["종로구"], "세종시", "부산 종로구", "수원시장안구")
ZONES = ("서울", "경상", "경상도", "충청남도", " 제주도　", "", "강원", "없음", _NFD["서울"], "인천.경기", "도")
TOWNS = ("서울", "고성", "광주", "순천", "순천시", "고성(", "", " 제주\t", "평양", _NFD["서울"])


def _values(text: str) -> list[tuple[str, ...]]:
    return [tuple(line.split()) for line in text.splitlines() if line]


def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _sql_rows(text: str) -> str:
    return ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in _values(text))


def _asked(spark: SparkSession, sf_dir: str, values: tuple[str, ...]) -> DataFrame:
    """Every customer asks for a place."""
    place = F.element_at(F.array(*[F.lit(v) for v in values]),
                         (F.col("c_custkey") % len(values) + 1).cast("int"))
    return read(spark, sf_dir, "customer").select("c_custkey", place.alias("query"))


def _asked_sql(values: tuple[str, ...]) -> str:
    return (f"asked as (select c_custkey, {_sql_list(values)}[c_custkey % {len(values)} + 1] as query "
            "from customer)")


_OUTCOME_SQL = """
    select a.c_custkey, a.query,
           case when coalesce(n, 0) = 0 then 'none' when n = 1 then 'ok' else 'ambiguous' end as status,
           case when n = 1 then code end as code,
           case when n > 1 then candidates end as candidates
    from asked a left join found f on f.query = a.query"""


def _flat(df: DataFrame) -> DataFrame:
    return df.withColumn("candidates", F.array_join("candidates", ", "))


_ALIASES = " ".join(f"when h = '{short}' then '{full}'" for short, full in PROVINCE_ALIASES.items())


@query("resolve_region", f"""
    with {_asked_sql(PLACES)},
      districts(sido, sigungu, code) as (values {_sql_rows(DISTRICTS)}),
      split as (select query, list_filter(regexp_split_to_array(
          replace(nfc_normalize(query), '　', ' '), '\\s+'), lambda w: w <> '') as words
        from (select distinct query from asked) as q),
      matched as (
        select s.query, d.* from split s join districts d
          on d.sigungu = s.words[-1]
             or (ends_with(d.sigungu, s.words[-1]) and ends_with(left(d.sigungu, length(d.sigungu) - length(s.words[-1])), '시'))
        where len(s.words) > 0 and len(list_filter(s.words[:-2], lambda h: not (
          contains(d.sido, h) or coalesce(d.sido = case {_ALIASES} end, false) or starts_with(d.sigungu, h)))) = 0),
      found as (select query, count(*) as n, min(code) as code,
                       string_agg(sido || ' ' || sigungu, ', ' order by sido || ' ' || sigungu) as candidates
                from matched group by query)
    {_OUTCOME_SQL}""")
def _(spark, sf_dir):
    districts = spark.createDataFrame(_values(DISTRICTS), "sido string, sigungu string, code string")
    return _flat(resolve_region(_asked(spark, sf_dir, PLACES), districts))


def _named_sql(values: tuple[str, ...], rows: str) -> str:
    return f"""
    with {_asked_sql(values)},
      names(name, code) as (values {_sql_rows(rows)}),
      tidy as (select distinct query, regexp_replace(nfc_normalize(query), '^[\\s　]+|[\\s　]+$', '', 'g') as q
               from asked),
      matched as (select query, name, code, name = q as exact from tidy join names on contains(name, q)),
      best as (select * from (select *, bool_or(exact) over (partition by query) as any_exact from matched) as m
               where exact or not any_exact),
      found as (select query, count(*) as n, min(code) as code,
                       string_agg(name, ', ' order by name) as candidates from best group by query)
    {_OUTCOME_SQL}"""


@query("resolve_land_zone", _named_sql(ZONES, LAND_ZONES))
def _(spark, sf_dir):
    return _flat(resolve_land_zone(_asked(spark, sf_dir, ZONES)))


@query("resolve_temp_city", _named_sql(TOWNS, CITIES))
def _(spark, sf_dir):
    cities = spark.createDataFrame(_values(CITIES), "name string, code string")
    return _flat(resolve_temp_city(_asked(spark, sf_dir, TOWNS), cities))


@query("resolve_many_names", """
    with names as (select o_orderkey || '-' || o_custkey as name, cast(o_orderkey as varchar) as code from orders),
      asked as (select c_custkey, case when c_custkey % 5 = 0 then null when c_custkey % 5 = 1 then c_custkey || '-' || c_custkey else c_custkey || '-' end as query from customer),
      found as (select c_custkey, count(name) as n, min(code) as code, string_agg(name, ', ' order by name) as candidates
                from asked join names on contains(name, query) group by c_custkey)
    select a.c_custkey, a.query, case when coalesce(n, 0) = 0 then 'none' when n = 1 then 'ok' else 'ambiguous' end as status,
           case when n = 1 then code end as code, case when n between 2 and 1000 then candidates end as candidates
    from asked a left join found f on f.c_custkey = a.c_custkey""")
def _(spark, sf_dir):
    """As many names as orders; a fifth of the rows ask nothing."""
    names = read(spark, sf_dir, "orders").select(F.concat_ws("-", "o_orderkey", "o_custkey").alias("name"), F.col("o_orderkey").cast("string").alias("code"))
    key = F.col("c_custkey").cast("string")
    asked = F.when(F.col("c_custkey") % 5 == 0, None).when(F.col("c_custkey") % 5 == 1, F.concat_ws("-", key, key)).otherwise(F.concat(key, F.lit("-")))
    return _flat(resolve_named(read(spark, sf_dir, "customer").select("c_custkey", asked.alias("query")), names))


@query("nfc", "select doc_id, nfc_normalize(text) as text from documents")
def _(spark, sf_dir):
    # Take two letters apart first, so that there is something to compose.
    apart = F.replace(F.replace("text", F.lit("é"), F.lit("e\u0301")), F.lit("ü"), F.lit("u\u0308"))
    return read(spark, sf_dir, "documents").select("doc_id", nfc(apart).alias("text"))


_LAT, _LON = "33 + (c_custkey * 37 % 600) / 100.0", "124 + (c_custkey * 53 % 700) / 100.0 + 360 * (c_custkey % 3 - 1)"


def _grid_sql() -> str:
    # The published projection written out from its constants.
    return f"""
    with points as (select c_custkey, cast(case when c_custkey % 50 = 7 then 95 else {_LAT} end as double) as lat,
                           cast({_LON} as double) as lon from customer),
      cone as (select ln(cos(radians(30)) / cos(radians(60))) / ln(tan(radians(75)) / tan(radians(60))) as n),
      scaled as (select n, 6371.00877 / 5 * cos(radians(30)) / n * pow(tan(radians(60)), n) as s from cone),
      polar as (select c_custkey, s / pow(tan(radians(45 + lat / 2)), n) as r,
                       n * radians(lon - 126 - 360 * round((lon - 126) / 360)) as a,
                       s / pow(tan(radians(64)), n) as r0, lat from points, scaled)
    select c_custkey, case when lat < 90 then cast(floor(r * sin(a) + 43.5) as int) end as nx,
           case when lat < 90 then cast(floor(r0 - r * cos(a) + 136.5) as int) end as ny
    from polar"""


@query("latlon_grid", _grid_sql())
def _(spark, sf_dir):
    lat = F.expr(f"cast(if(c_custkey % 50 = 7, 95, {_LAT}) as double)")
    cell = grid_cell(lat, F.expr(f"cast({_LON} as double)"))
    return (read(spark, sf_dir, "customer").select("c_custkey", cell.alias("cell"))
            .select("c_custkey", "cell.nx", "cell.ny"))


def _slots(operation: str) -> list[int]:
    first, step, _ = SCHEDULES[operation]
    return list(range(first, 24 * 60, step))


def _announced_sql(operation: str) -> str:
    # The latest of yesterday's and today's announcements that is not after the cutoff.
    lag = SCHEDULES[operation][2]
    minutes = [m - 1440 for m in _slots(operation)] + _slots(operation)
    return (f"list_max(list_filter(list_transform({minutes}, lambda m: date_trunc('day', ts) + to_minutes(m)), "
            f"lambda t: t <= ts - interval {lag} minutes))")


for _operation in SCHEDULES:
    add(f"latest_{_operation}",
        lambda spark, sf_dir, op=_operation: read(spark, sf_dir, "events").select(
            "event_id", latest_announcement(F.col("ts"), op, wall_clock=True).alias("a"))
        .select("event_id", "a.base_date", "a.base_time"),
        f"""select event_id, strftime(slot, '%Y%m%d') as base_date, strftime(slot, '%H%M') as base_time
            from (select event_id, {_announced_sql(_operation)} as slot from events) as t""")


@query("latest_from_instant", f"""
    select event_id, strftime(slot, '%Y%m%d') as base_date, strftime(slot, '%H%M') as base_time
    from (select event_id, {_announced_sql("forecast")} as slot
          from (select event_id, ts + interval 9 hours as ts from events) as e) as t""")
def _(spark, sf_dir):
    utc = F.to_timestamp_ltz(F.concat(F.col("ts").cast("string"), F.lit("Z")))
    return (read(spark, sf_dir, "events")
            .select("event_id", latest_announcement(utc, "forecast").alias("a"))
            .select("event_id", "a.base_date", "a.base_time"))


# --- merging -------------------------------------------------------------------------------

NET_ASSET = table("kofia.fund_net_asset")


def _old(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").selectExpr(
        "date_format(o_orderdate, 'yyyy-MM-dd') as base_date", "o_orderstatus as fund_type",
        "cast(o_custkey % 5 as string) as offering_type",
        "cast(round(o_totalprice * 100) as bigint) as net_asset_total",
        "1 as captured_at", "o_custkey as page", "o_orderkey as pos", "'old' as capture_id")


def _new(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").selectExpr(
        "date_format(l_shipdate, 'yyyy-MM-dd') as base_date", "l_linestatus as fund_type",
        "cast(l_suppkey % 5 as string) as offering_type",
        "cast(round(l_extendedprice * 100) as bigint) as net_asset_total",
        "2 as captured_at", "l_partkey as page", "l_orderkey * 7 + l_linenumber as pos", "'new' as capture_id")


_VERSIONS = """
    versions as (
      select strftime(o_orderdate, '%Y-%m-%d') as base_date, o_orderstatus as fund_type,
             cast(o_custkey % 5 as varchar) as offering_type,
             cast(round(o_totalprice * 100) as bigint) as net_asset_total,
             1 as captured_at, o_custkey as page, o_orderkey as pos, 'old' as capture_id from orders
      union all
      select strftime(l_shipdate, '%Y-%m-%d'), l_linestatus, cast(l_suppkey % 5 as varchar),
             cast(round(l_extendedprice * 100) as bigint), 2, l_partkey, l_orderkey * 7 + l_linenumber, 'new'
      from lineitem)"""


@query("upsert_by_key", f"""
    with {_VERSIONS}
    select base_date, fund_type, offering_type, net_asset_total, capture_id from (
      select *, row_number() over (partition by base_date, fund_type, offering_type
        order by captured_at desc, page desc, pos desc, net_asset_total desc) as nth from versions) as t
    where nth = 1""")
def _(spark, sf_dir):
    merged = upsert_by_key(_old(spark, sf_dir), _new(spark, sf_dir), NET_ASSET,
                           ("captured_at", "page", "pos", "net_asset_total"))
    return merged.select(*NET_ASSET.columns, "capture_id")


@query("replace_period", f"""
    with {_VERSIONS}
    select base_date, fund_type, offering_type, net_asset_total, capture_id || ':' || page || ':' || pos as row_id
    from versions where capture_id = 'new'
    union all
    select v.base_date, v.fund_type, v.offering_type, v.net_asset_total, v.capture_id || ':' || v.page || ':' || v.pos
    from (select * from versions where capture_id = 'old') v
      anti join (select distinct base_date, fund_type, offering_type from versions where capture_id = 'new') n
      on n.base_date = v.base_date and n.fund_type = v.fund_type and n.offering_type = v.offering_type""")
def _(spark, sf_dir):
    period = ["base_date", "fund_type", "offering_type"]
    merged = replace_periods(_old(spark, sf_dir), _new(spark, sf_dir), period)
    return with_row_id(merged).select(*NET_ASSET.columns, "row_id")


@query("rows_to_json", """
    select cast(to_json({'doc_id': doc_id, 'lang': lang, 'text': text,
                         'source': case when doc_id % 5 = 0 then null else source end}) as varchar) as json
    from documents""")
def _(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", "lang", "text", F.when(F.col("doc_id") % 5 != 0, F.col("source")).alias("source"))
    return rows_to_json(docs)
