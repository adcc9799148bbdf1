"""Response bodies, their status, paging, and whole fetches end to end."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import landed, untidy
from checks.registry import Query, add, query, raw_from
from checks.typed import BID_COLUMNS, GRID_SQL, bid_rows, bids_sql, grid_rows
from checks.untidy import ORDERS, read
from portalake import (clean, complete_only, fetch, generic_rows, page_audit, parse_pages, raw_rows, read_captures,
                       refused, replace_table, table, typed_rows, upsert_table, vendor_rows, write_captures)
from portalake.functions import parsers, status
from portalake.functions.text import redact
from portalake.schema import Table
from portalake.session import shared_folder

FUNDS, TRADE, CMA = table("kofia.market_funds"), table("customs.item_trade"), table("kofia.cma_status")
FETCH, PAGE = landed.FETCH_ROWS, landed.PAGE_ROWS


def _exact_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order rows whose numbers a JSON reader would spell differently."""
    return raw_from(read(spark, sf_dir, "orders"), key="o_orderkey", id="o_orderkey",
                    price="format_string('%.3f', o_totalprice)",
                    big="concat(o_orderkey * 1000000007 * 1009, '.0')",
                    power="concat(o_orderkey, 'E400')",
                    note=r"""concat('"', o_orderpriority, '\\ <&> 한')""",
                    empty="if(o_orderstatus = 'P', null, '')")


_EXACT_SQL = rf"""
    select 'fetch-' || (o_orderkey // {FETCH}) as capture_id,
           cast((o_orderkey % {FETCH}) // {PAGE} + 1 as int) as page,
           cast(o_orderkey % {PAGE} as int) as pos,
           cast(o_orderkey as varchar) as id, printf('%.3f', o_totalprice) as price,
           (o_orderkey * 1000000007 * 1009) || '.0' as big, o_orderkey || 'E400' as power,
           '"' || o_orderpriority || '\ <&> 한' as note,
           case when o_orderstatus = 'P' then null else '' end as empty
    from orders"""


def _exact(fmt: str) -> Query:
    t = FUNDS if fmt == "json" else TRADE

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        pages = landed.paged(_exact_rows(spark, sf_dir), fmt)
        make = landed.json_body if fmt == "json" else landed.xml_body
        body = make(F.col("items"), F.col("total").cast("string"))
        rows = raw_rows(parse_pages(pages.select(*landed.capture_columns(t, body))))
        return rows.select("capture_id", "page", "pos", *[
            F.col("raw")[c].alias(c) for c in ("id", "price", "big", "power", "note", "empty")])

    return run


add("parse_json_envelope", _exact("json"), _EXACT_SQL)
add("parse_xml_envelope", _exact("xml"), _EXACT_SQL)


def _single_bodies(spark: SparkSession, sf_dir: str, body: str, fmt: str = "json",
                   source: str = "orders", key: str = "o_orderkey", http: str = "200",
                   retry: str = "cast(null as string)") -> DataFrame:
    """One landed body per row of a table."""
    df = read(spark, sf_dir, source).withColumn("f", F.expr(key)).withColumn("page", F.lit(1))
    return df.select(*landed.capture_columns(
        FUNDS, F.expr(body), fmt=F.lit(fmt), http_status=F.expr(http).cast("int"),
        retry_after=F.expr(retry)))


def _fault(err: str, auth: str, code: str) -> str:
    return (f"concat('<OpenAPI_ServiceResponse><cmmMsgHeader><errMsg>', {err}, "
            f"'</errMsg><returnAuthMsg>', {auth}, '</returnAuthMsg><returnReasonCode>', {code}, "
            "'</returnReasonCode></cmmMsgHeader></OpenAPI_ServiceResponse>')")


@query("json_xml_fallback", """
    select 'fetch-' || o_orderkey as capture_id,
           case o_orderkey % 4 when 0 then 'ok' when 1 then 'auth' when 2 then 'rate_limited'
                else 'malformed' end as status,
           case o_orderkey % 4 when 0 then '00' when 1 then '30' when 2 then '022' end as code,
           case o_orderkey % 4 when 1 then 'KEY ' || o_custkey when 2 then 'LIMIT'
                when 3 then 'neither JSON nor XML' end as message
    from orders""")
def _(spark, sf_dir):
    body = ("""case o_orderkey % 4
            when 0 then '{"response":{"header":{"resultCode":"00"},"body":{"items":""}}}'
            when 1 then """ + _fault("'x'", "concat('KEY ', o_custkey)", "'30'")
            + " when 2 then " + _fault("'LIMIT'", "''", "'022'")
            + " else '<html><p>maintenance' end")
    return parse_pages(_single_bodies(spark, sf_dir, body)).select("capture_id", "status", "code", "message")


@query("normalize_items", """
    select 'fetch-' || o_orderkey as capture_id,
           case when o_orderkey % 10 >= 8 then 'malformed' else 'ok' end as status,
           cast(case o_orderkey % 10 when 0 then 2 when 1 then 1 when 2 then 1 else 0 end as int) as n,
           case when o_orderkey % 10 <= 2 then o_orderpriority end as first_value
    from orders""")
def _(spark, sf_dir):
    row = """'{"v":"', o_orderpriority, '"}'"""
    items = f"""case o_orderkey % 10
        when 0 then concat('"items":{{"item":[', {row}, ',{{}}]}}')
        when 1 then concat('"items":{{"item":', {row}, '}}')
        when 2 then concat('"items":[', {row}, ']')
        when 3 then '"items":""' when 4 then '"items":"  "' when 5 then '"items":{{}}'
        when 6 then '"x":1' when 7 then '"items":{{"item":{{}}}}'
        when 8 then concat('"items":{{"item":[', {row}, ',7]}}')
        else '"items":{{"item":"text"}}' end"""
    body = f"""concat('{{"response":{{"header":{{"resultCode":"0"}},"body":{{', {items}, '}}}}}}')"""
    pages = parse_pages(_single_bodies(spark, sf_dir, body))
    first = F.try_element_at("items", F.lit(1))["v"]
    return pages.select("capture_id", "status", "n", first.alias("first_value"))


@query("raw_rows", """
    select 'fetch-' || o_orderkey as capture_id, o_orderpriority as a, '' as b,
           cast(o_custkey as varchar) as extra, cast(null as varchar) as absent, 3 as tokens
    from orders""")
def _(spark, sf_dir):
    body = """concat('{"response":{"header":{"resultCode":"00"},"body":{"items":{"item":[{"a":"',
        o_orderpriority, '","b":null,"extra":', o_custkey, '}]},"totalCount":1}}}')"""
    rows = raw_rows(parse_pages(_single_bodies(spark, sf_dir, body)))
    return rows.select("capture_id", *[F.col("raw")[c].alias(c) for c in ("a", "b", "extra", "absent")],
                       F.size("raw").alias("tokens"))


@query("generic_service_rows", "select doc_id, lang, text from documents")
def _(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").withColumn("f", F.col("doc_id")).withColumn("page", F.lit(1))
    # Whole texts travel through the envelope; to_json escapes them.
    body = landed.json_body(F.array(F.to_json(F.struct("doc_id", "lang", "text"))), F.lit("1"))
    captures = docs.select(*landed.capture_columns(
        FUNDS, body, service=F.lit("other"), operation=F.lit("docs")))
    raw = F.col("raw")
    return generic_rows(captures, "other", "docs").select(
        raw["doc_id"].cast("bigint").alias("doc_id"), raw["lang"].alias("lang"), raw["text"].alias("text"))


@query("result_code", """
    select o_orderkey as k, case when o_orderkey % 7 = 0 then '?' when o_orderkey % 7 = 6 then '0'
                                 else cast(o_custkey as varchar) end as code
    from orders""")
def _(spark, sf_dir):
    text = """case o_orderkey % 7 when 0 then null when 6 then ' 000 '
                                  else concat(' ', repeat('0', int(o_orderkey % 7)), o_custkey) end"""
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), status.result_code(F.expr(text)).alias("code"))


@query("classify_errors", """
    with codes as (
      select event_id, cast([0, 3, 1, 4, 12, 20, 22, 23, 30, 31, 99, 77][event_id % 12 + 1] as varchar) as code
      from events)
    select event_id, code,
           case when code = '0' then 'ok' when code = '3' then 'no_data'
                when code in ('20', '30', '31') then 'auth' when code in ('22', '23') then 'rate_limited'
                else 'response_error' end as status,
           code in ('1', '4', '12', '20', '22', '23', '30', '31', '99') as documented
    from codes""")
def _(spark, sf_dir):
    padded = ("lpad(array('0', '3', '1', '4', '12', '20', '22', '23', '30', '31', '99', '77')"
              "[int(event_id % 12)], 3, '0')")
    events = read(spark, sf_dir, "events").select("event_id", status.result_code(F.expr(padded)).alias("code"))
    known = status.reason_codes(spark).select("code", "reason")
    return (events.withColumn("status", status.result_status(F.col("code")))
            .join(known, "code", "left")
            .select("event_id", "code", "status", F.col("reason").isNotNull().alias("documented")))


@query("http_status_class", """
    select event_id, case event_id % 8 when 2 then 'rate_limited' when 3 then 'auth' when 4 then 'auth'
                         when 5 then 'network' when 6 then 'network' when 7 then 'network' end as failure
    from events""")
def _(spark, sf_dir):
    code = F.expr("array(200, 204, 429, 401, 403, 302, 500, 404)[int(event_id % 8)]")
    return read(spark, sf_dir, "events").select("event_id", status.http_status_class(code).alias("failure"))


@query("retry_after", """
    select event_id, case event_id % 6 when 0 then user_id when 1 then user_id when 2 then 0 end as seconds
    from events""")
def _(spark, sf_dir):
    header = """case event_id % 6 when 0 then cast(user_id as string) when 1 then concat(' +', user_id, ' ')
        when 2 then '-0' when 3 then concat('-', user_id + 1) when 4 then 'Wed, 21 Oct 2026 07:28:00 GMT' end"""
    return read(spark, sf_dir, "events").select(
        "event_id", parsers.retry_after(F.expr(header)).alias("seconds"))


@query("http_status_first", """
    select 'fetch-' || event_id as capture_id,
           case event_id % 4 when 0 then 'no_data' when 1 then 'rate_limited' when 2 then 'auth'
                else 'network' end as status,
           case event_id % 4 when 0 then '003' when 1 then '429' when 2 then '401' else '502' end as code,
           case when event_id % 4 = 1 then user_id end as retry_after
    from events""")
def _(spark, sf_dir):
    body = """'{"response":{"header":{"resultCode":"003"},"body":{}}}'"""
    pages = parse_pages(_single_bodies(spark, sf_dir, body, source="events", key="event_id",
                                       http="array(200, 429, 401, 502)[int(event_id % 4)]",
                                       retry="cast(user_id as string)"))
    return pages.select("capture_id", "status", "code", "retry_after")


@query("fault_messages", """
    select 'fetch-' || o_orderkey as capture_id,
           case o_orderkey % 3 when 0 then 'auth ' || o_custkey when 1 then o_orderpriority
                else 'portal fault for getSecuritiesMarketTotalCapitalInfo' end as message
    from orders""")
def _(spark, sf_dir):
    body = """to_json(named_struct('OpenAPI_ServiceResponse', named_struct('cmmMsgHeader', named_struct(
        'returnAuthMsg', if(o_orderkey % 3 = 0, concat(' auth ', o_custkey), ''),
        'errMsg', case o_orderkey % 3 when 1 then o_orderpriority when 2 then '' else 'unused' end,
        'returnReasonCode', '99'))))"""
    return parse_pages(_single_bodies(spark, sf_dir, body)).select("capture_id", "message")


@query("redact", "select doc_id, text || '|[REDACTED]|' || text as message from documents")
def _(spark, sf_dir):
    # The made-up key as given, as a form value, and as a path part.
    form = F.expr("array('aB3+/x y==', 'aB3%2B%2Fx+y%3D%3D', 'aB3%2B/x%20y%3D%3D')[int(doc_id % 3)]")
    message = F.concat("text", F.lit("|"), form, F.lit("|"), "text")
    return read(spark, sf_dir, "documents").select("doc_id", redact(message, "aB3+/x y==").alias("message"))


# --- paging --------------------------------------------------------------------------------

def _broken(spark: SparkSession, sf_dir: str, t: Table) -> DataFrame:
    return parse_pages(landed.broken(untidy.vendor_rows(spark, sf_dir, t, ORDERS), t), t)


_AUDIT = f"with {landed.BROKEN_PAGES_SQL}"


@query("page_audit", f"""{_AUDIT} select capture_id, status, "rows", total, last_page from audit""")
def _(spark, sf_dir):
    return page_audit(_broken(spark, sf_dir, CMA)).select(
        "capture_id", "status", "rows", "total", "last_page")


@query("page_audit_long", """
    select 'long' as capture_id, 'complete' as status, count(*) as "rows", cast(count(*) as int) as last_page,
           cast(null as varchar) as message from orders
    union all
    select 'odd-' || c_custkey % 40, case when bool_or(c_custkey % 120 >= 80) then 'incomplete' else 'complete' end,
           1, case when bool_or(c_custkey % 120 >= 80) then null else 1 end,
           case when bool_or(c_custkey % 120 >= 80) then 'a page without a number' end
    from customer where c_custkey % 40 < 20 or c_custkey % 120 < 40 group by c_custkey % 40""")
def _(spark, sf_dir):
    """One capture of as many pages as there are orders, and captures whose pages have no number
    (a null, or a zero)."""
    orders, customers = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    body = lambda n: landed.json_body(F.array(F.lit('{"a": 1}')), n.cast("string"))
    long = orders.withColumn("n", F.lit(orders.count())).withColumn("f", F.lit(0)).withColumn("page", F.col("o_orderkey").cast("int") + 1)
    long = long.select(*landed.capture_columns(FUNDS, body(F.col("n")), capture_id=F.lit("long"), fmt=F.lit("json"), num_of_rows=F.lit(1)))
    odd = (customers.where("c_custkey % 40 < 20 or c_custkey % 120 < 40").withColumn("f", F.lit(0))
           .withColumn("page", F.expr("case when c_custkey % 120 < 80 then 1 when c_custkey % 240 < 200 then null else 0 end").cast("int")))
    odd = odd.select(*landed.capture_columns(FUNDS, body(F.lit(1)), capture_id=F.concat(F.lit("odd-"), F.expr("c_custkey % 40")), fmt=F.lit("json"), num_of_rows=F.lit(1)))
    return page_audit(parse_pages(long.unionByName(odd))).select("capture_id", "status", "rows", "last_page", "message")


@query("refused_fetches", f"""{_AUDIT}
    select capture_id, status, case status when 'rate_limited' then 'TRAFFIC EXCEEDED'
      when 'network' then 'HTTP 503' when 'malformed' then 'neither JSON nor XML' end as message
    from audit where status <> 'complete'""")
def _(spark, sf_dir):
    return refused(page_audit(_broken(spark, sf_dir, TRADE))).select("capture_id", "status", "message")


@query("empty_fetches", f"""{_AUDIT}
    select capture_id from audit where status = 'complete' and "rows" = 0""")
def _(spark, sf_dir):
    audit = page_audit(_broken(spark, sf_dir, CMA))
    return audit.where((F.col("status") == "complete") & (F.col("rows") == 0)).select("capture_id")


@query("complete_only", f"""{_AUDIT}
    select capture_id, page, pos, k from (
      select a.capture_id, cast((o_orderkey % {FETCH}) // {PAGE} + 1 as int) as page,
             cast(o_orderkey % {PAGE} as int) as pos, o_orderkey as k, last_page, a.f
      from orders join audit a on a.f = o_orderkey // {FETCH} where status = 'complete') as t
    where page <= last_page and not (f % 10 = 6 and page = 1)
      and not (f % 10 = 5 and page = 3)""")
def _(spark, sf_dir):
    t = table("weather.nowcast")
    rows = raw_from(read(spark, sf_dir, "orders"), key="o_orderkey", nx="o_orderkey", category="o_orderstatus")
    pages = parse_pages(landed.broken(rows, t), t)
    out = raw_rows(complete_only(pages, page_audit(pages)))
    return out.select("capture_id", "page", "pos", F.col("raw")["nx"].cast("bigint").alias("k"))


# --- landed bodies to one dataset, end to end ----------------------------------------------

def _fetched(name: str, where: str, override: dict | None = None, **arguments) -> None:
    t = table(name)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        extra = {k: F.expr(v) for k, v in (override or {}).items()}
        captures = landed.intact(untidy.vendor_rows(spark, sf_dir, t, ORDERS), t, **extra)
        return fetch(captures, name, **arguments)

    add(f"fetch_{name.replace('.', '_')}", run, untidy.clean_sql(t, ORDERS, where))


_fetched("kofia.market_funds", "base_date between '1996-01-01' and '1999-12-31'",
         begin="19960101", end="19991231")
_fetched("kofia.dls_dlb", "base_ym <= '1998-06'", end="19980630")
_fetched("customs.item_trade", "hs_code = 'O' and period between '1995-01' and '2001-12'",
         hs_code="O", begin="199501", end="200112")
_fetched("holidays.holidays", """"date" between '1997-01-01' and '1997-12-31'""", year=1997)
_fetched("realestate.apt_trade_detail",
         "region_code = 'O' and deal_date between '1996-04-01' and '1996-04-30'",
         region_code="O", deal_ym="199604")
_fetched("airquality.by_sido", "sido = '5-LOW'", sido="5-LOW")
_fetched("midforecast.temperature", "region_code = '1-URGENT'", region_code="1-URGENT",
         base_time="202401050600", override={"params": "map('tmFc', '202401050600')"})


@query("fetch_procurement_construction", bids_sql("opened", "1997-01-01 00:00", "1997-12-31 23:30"))
def _(spark, sf_dir):
    t = table("procurement.construction")
    captures = landed.intact(bid_rows(spark, sf_dir), t)
    rows = fetch(captures, t.full_name, begin="199701010000", end="199712312329", query_basis="2")
    return rows.select(*BID_COLUMNS)


@query("fetch_weather_forecast", GRID_SQL)
def _(spark, sf_dir):
    t = table("weather.forecast")
    captures = landed.intact(grid_rows(spark, sf_dir), t)
    # 17:20 in Korea: the 17:00 announcement is out.
    return fetch(captures, t.full_name, nx=7, ny=127, now=F.timestamp_seconds(F.lit(1704442800)))


# --- the other tables, each fetched from captures that hold another operation as well --------

def _mixed(name: str, beside: str, sql: str, rows=None, columns=None, override: dict | None = None, **arguments) -> None:
    """Two tables landed together under the same capture ids; only the asked one comes out."""
    t, other = table(name), table(beside)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        extra = {k: F.expr(v) for k, v in (override or {}).items()}
        mine = rows(spark, sf_dir) if rows else untidy.vendor_rows(spark, sf_dir, t, ORDERS)
        captures = landed.intact(mine, t, **extra).unionByName(landed.intact(untidy.vendor_rows(spark, sf_dir, other, ORDERS), other))
        out = fetch(captures, name, **arguments)
        return out.select(*columns) if columns else out

    add(f"fetch_{name.replace('.', '_')}", run, sql)


def _mixed_orders(name: str, beside: str, where: str = "true", override: dict | None = None, **arguments) -> None:
    _mixed(name, beside, untidy.clean_sql(table(name), ORDERS, where), override=override, **arguments)


for _name in ("credit_balance", "fund_net_asset", "cma_status"):
    _mixed_orders(f"kofia.{_name}", "kofia.els_elb", "base_date between '1996-01-01' and '1998-12-31'", begin="19960101", end="19981231")
for _name in ("els_elb", "trust_scale", "overseas_derivatives"):
    _mixed_orders(f"kofia.{_name}", "kofia.cma_status", "base_ym >= '1997-02'", begin="199702")
for _name in ("national_holidays", "anniversaries", "solar_terms", "sundry_days"):
    _mixed_orders(f"holidays.{_name}", "holidays.holidays", """"date" between '1995-01-01' and '1995-12-31'""", year=1995)
for _name in ("apt_trade", "apt_rent", "apt_presale"):
    _mixed_orders(f"realestate.{_name}", "realestate.apt_trade_detail", "region_code = 'O' and deal_date between '1996-04-01' and '1996-04-30'",
                  region_code="O", deal_ym="199604")
_mixed_orders("midforecast.land", "midforecast.temperature", "region_code = '1-URGENT'", {"params": "map('tmFc', '202401050600')"},
              region_code="1-URGENT", base_time="202401050600")
_mixed_orders("airquality.by_station", "airquality.by_sido", "station = 'O'", station="O")
for _name in ("goods", "services", "foreign"):
    _mixed(f"procurement.{_name}", "procurement.construction", bids_sql("noticed", "1996-01-01 00:00", "1996-12-31 23:31"), rows=bid_rows,
           columns=BID_COLUMNS, begin="199601010000", end="199612312330")
_mixed("weather.ultra_forecast", "weather.nowcast", GRID_SQL, rows=grid_rows, nx=7, ny=127, base_date="20240105", base_time="1700")
_mixed("weather.nowcast", "weather.ultra_forecast", """
    select '2024-01-05' as base_date, '1700' as base_time, event_type as category, cast(value as varchar) as observed_value,
           cast(7 as bigint) as nx, cast(127 as bigint) as ny
    from events where user_id % 10 = 7 and ts >= timestamp '2024-01-05 12:00' and ts < timestamp '2024-01-06'""",
       rows=lambda spark, sf_dir: raw_from(
           read(spark, sf_dir, "events"), key="event_id", baseDate="date_format(ts, 'yyyyMMdd')", baseTime="if(hour(ts) >= 12, '1700', '0500')",
           category="event_type", obsrValue="value", nx="user_id % 10", ny="127"),
       nx=7, ny=127, base_date="20240105", base_time="1700")


# --- decoding, passing on unchanged, and stored tables ----------------------------------------

@query("decode_bodies", """
    select 'fetch-' || o_orderkey as capture_id, case when o_orderkey % 4 = 3 then 'malformed' else 'ok' end as status,
           case when o_orderkey % 4 = 3 then 'undecodable body' end as message,
           case when o_orderkey % 4 <> 3 then o_orderpriority || ' 한글' end as value
    from orders""")
def _(spark, sf_dir):
    """A byte order mark before JSON or XML, plain text, and bytes that are no UTF-8."""
    body = F.expr("""case o_orderkey % 4
        when 0 then encode(concat('\\ufeff{"response":{"header":{"resultCode":"00"},"body":{"items":{"item":[{"a":"', o_orderpriority, ' 한글"}]}}}}'), 'UTF-8')
        when 1 then encode(concat('\\ufeff<response><header><resultCode>00</resultCode></header><body><items><item><a>', o_orderpriority, ' 한글</a></item></items></body></response>'), 'UTF-8')
        when 2 then encode(concat('{"response":{"header":{"resultCode":"00"},"body":{"items":{"item":[{"a":"', o_orderpriority, ' 한글"}]}}}}'), 'UTF-8')
        else concat(unhex('C3'), encode(o_orderpriority, 'UTF-8')) end""")
    df = read(spark, sf_dir, "orders").withColumn("f", F.col("o_orderkey")).withColumn("page", F.lit(1))
    captures = df.select(*landed.capture_columns(FUNDS, F.lit("")), body.alias("bytes"), F.expr("if(o_orderkey % 4 = 1, 'xml', 'json')").alias("form"))
    captures = captures.withColumn("body", F.col("bytes")).withColumn("fmt", F.col("form")).drop("bytes", "form")
    return parse_pages(captures).select("capture_id", "status", "message", F.get("items", F.lit(0))["a"].alias("value"))


@query("vendor_rows", """
    select o_orderkey as k, '19960101' as "basDt", ' ' || o_orderpriority || ' ' as "unknownToken"
    from orders""")
def _(spark, sf_dir):
    """Rows of a declared table as the vendor sent them, unknown tokens and blanks included."""
    rows = raw_from(read(spark, sf_dir, "orders"), key="o_orderkey", basDt="'19960101'", id="o_orderkey", unknownToken="concat(' ', o_orderpriority, ' ')")
    raw = F.col("raw")
    return vendor_rows(landed.intact(rows, CMA), CMA.full_name).select(
        raw["id"].cast("bigint").alias("k"), raw["basDt"].alias("basDt"), raw["unknownToken"].alias("unknownToken"))


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}"


@query("stored_upsert", """
    select strftime(o_orderdate, '%Y-%m-%d') as base_date, cast(o_orderkey as varchar) as fund_type,
           case when o_orderkey % 3 = 0 then o_orderkey * 7 else o_orderkey * 10 end as net_asset_total
    from orders""")
def _(spark, sf_dir):
    """Stored captures to a stored table, and a second batch merged into it."""
    t, folder = table("kofia.fund_net_asset"), _folder(spark)
    orders = read(spark, sf_dir, "orders")
    for i, (some, factor) in enumerate((("true", 10), ("o_orderkey % 3 = 0", 7))):
        rows = raw_from(orders.where(some), key="o_orderkey", basDt="date_format(o_orderdate, 'yyyyMMdd')", ctg="o_orderkey", tstMthdCtg="'a'",
                        nPptTotAmt=f"o_orderkey * {factor}")
        captured = F.timestamp_seconds(F.lit(1_700_000_000 + i))
        # A fetch of the second batch has gaps in its page numbers, so pages are one row each.
        pages = rows.select(F.col("k").alias("f"), F.lit(1).alias("page"), F.array(landed.json_item(F.col("raw"))).alias("items"))
        write_captures(pages.select(*landed.capture_columns(t, landed.json_body(F.col("items"), F.lit("1")), captured_at=captured)), f"{folder}/captures-{i}")
        upsert_table(typed_rows(read_captures(spark, f"{folder}/captures-{i}"), t.full_name, keep=("capture_id", "page", "captured_at", "pos")), f"{folder}/table", t)
    return spark.read.parquet(f"{folder}/table").select("base_date", "fund_type", "net_asset_total")


@query("stored_replace", """
    select strftime(ts, '%Y-%m-%d') as base_date, cast(event_id as varchar) as category, user_id % 10 as nx,
           case when user_id % 10 = 3 then 'new' else 'old' end as observed_value
    from events""")
def _(spark, sf_dir):
    """A wide table stored, then one grid cell of every day fetched anew: the other cells stay."""
    t, folder = table("weather.nowcast"), _folder(spark)
    for i, (some, value) in enumerate((("true", "old"), ("user_id % 10 = 3", "new"))):
        rows = raw_from(read(spark, sf_dir, "events").where(some), key="event_id", baseDate="date_format(ts, 'yyyyMMdd')", baseTime="'0500'",
                        category="event_id", obsrValue=f"'{value}'", nx="user_id % 10", ny="127")
        rows = clean(rows.withColumns({"capture_id": F.lit(f"c{i}"), "page": F.lit(1), "pos": F.col("k"), "captured_at": F.timestamp_seconds(F.lit(1_700_000_000 + i)),
                                       "params": F.create_map().cast("map<string,string>")}), t, keep=("capture_id", "page", "pos", "captured_at", "params"))
        replace_table(rows, f"{folder}/table", t)
    return spark.read.parquet(f"{folder}/table").select("base_date", "category", "nx", "observed_value")
