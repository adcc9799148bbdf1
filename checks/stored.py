"""Stored tables: requests that open the months they name, refetches that remove, pages kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import landed, untidy
from checks.registry import add, query, raw_from
from checks.typed import BID_COLUMNS, GRID_SQL, bid_rows, bids_sql, grid_rows
from checks.untidy import ORDERS, read
from portalake import (clean, fetch, in_order, parse_pages, raw_rows, read_bodies, refresh_table, rejects, select_rows, stage_pages,
                       table, typed_rows, with_records, write_table)
from portalake.session import shared_folder
from portalake.sinks.tables import with_period


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/stored-{uuid.uuid4().hex}"


def _stored(name: str, sql: str, rows=None, columns=None, as_: str = "", **arguments) -> None:
    """A whole table typed and stored, then read back for one request."""
    t = table(name)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = _folder(spark)
        raw = rows(spark, sf_dir) if rows else untidy.vendor_rows(spark, sf_dir, t, ORDERS)
        lineage = {"captured_at": F.timestamp_seconds(F.lit(1_700_000_000)), "params": F.create_map(F.lit("tmFc"), F.lit("202401050600"))}
        typed = clean(raw.withColumns(lineage), t, keep=tuple(lineage))
        write_table(with_period(typed, t), folder, table=t)
        out = select_rows(spark.read.parquet(folder), name, **arguments)
        return out.select(*(columns or t.columns))

    add(f"stored_{as_ or name.replace('.', '_')}", run, sql)


def _stored_orders(name: str, where: str, **arguments) -> None:
    _stored(name, untidy.clean_sql(table(name), ORDERS, where), **arguments)


_stored_orders("kofia.credit_balance", "base_date between '1996-01-01' and '1996-12-31'", begin="19960101", end="19961231")
_stored_orders("kofia.trust_scale", "base_ym >= '1997-02'", begin="199702")
_stored_orders("holidays.holidays", """"date" between '1997-03-01' and '1997-03-31'""", year=1997, month=3)
_stored_orders("realestate.apt_rent", "region_code = 'O' and deal_date between '1996-04-01' and '1996-04-30'", region_code="O", deal_ym="199604")
_stored_orders("customs.item_trade", "hs_code = 'O' and period between '1995-01' and '1996-12'", hs_code="O", begin="199501", end="199612")
_stored_orders("midforecast.land", "region_code = '1-URGENT'", region_code="1-URGENT", base_time="202401050600")
_stored("procurement.goods", bids_sql("noticed", "1996-01-01 00:00", "1996-12-31 23:31"), rows=bid_rows, columns=BID_COLUMNS,
        begin="199601010000", end="199612312330")
_stored("procurement.construction", bids_sql("opened", "1997-01-01 00:00", "1997-12-31 23:30"), rows=bid_rows, columns=BID_COLUMNS,
        begin="199701010000", end="199712312329", query_basis="2")
_stored("weather.forecast", GRID_SQL, rows=grid_rows, nx=7, ny=127, base_date="20240105", base_time="1700")


@query("fetch_folder_of_bodies", """
    select cast(p_partkey as varchar) as region_code, cast(p_size as bigint) as precip_prob_4am, p_brand as sky_8
    from part where p_partkey % 2 = 0""")
def _(spark, sf_dir):
    """Response files in a folder and their request records beside them: the announcement asked for is
    told by the records alone. Every other region was asked for at another time."""
    t, folder = table("midforecast.land"), _folder(spark)
    rows = raw_from(read(spark, sf_dir, "part"), key="p_partkey", regId="p_partkey", rnSt4Am="p_size", wf8="p_brand")
    pages = rows.select(F.expr("k % 40").alias("f"), "raw").groupBy("f").agg(F.collect_list(landed.xml_item(F.col("raw"))).alias("items"))
    # A text file holds a body as one line; new lines between elements say nothing.
    body = F.translate(landed.xml_body(F.col("items"), F.size("items").cast("string")), "\n", " ")
    place = [F.lit(t.service).alias("service"), F.lit(t.operation).alias("operation"), F.concat(F.lit("c/"), "f").alias("capture_id"), F.lit(1).alias("page")]
    pages.select(*place, body.alias("value")).write.partitionBy("service", "operation", "capture_id", "page").text(f"{folder}/bodies")
    asked = F.create_map(F.lit("tmFc"), F.when(F.col("f") % 2 == 0, "202401050600").otherwise("202401051800"))
    pages.select(*place, asked.alias("params"), F.lit(1_000_000).alias("num_of_rows")).write.parquet(f"{folder}/records")
    captures = with_records(read_bodies(spark, f"{folder}/bodies", "xml"), spark.read.parquet(f"{folder}/records"))
    parts = read(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("region_code"))
    told = typed_rows(captures, t.full_name, keep=("params",)).where(F.col("params")["tmFc"] == "202401050600")
    return told.join(parts, "region_code", "left_semi").select("region_code", "precip_prob_4am", "sky_8")


@query("row_order", f"""
    select 'long' as capture_id, cast(o_orderkey + 1 as int) as page, cast(0 as int) as pos, cast(o_orderkey as bigint) as ordinal from orders
    union all
    select 'fetch-' || c_custkey // {landed.FETCH_ROWS}, cast((c_custkey % {landed.FETCH_ROWS}) // {landed.PAGE_ROWS} + 1 as int),
           cast(c_custkey % {landed.PAGE_ROWS} as int), cast(c_custkey % {landed.FETCH_ROWS} as bigint) from customer""")
def _(spark, sf_dir):
    """The place of every row in its fetch: one of as many pages as there are orders, and others."""
    t = table("kofia.market_funds")
    long = read(spark, sf_dir, "orders").withColumn("f", F.lit(0)).withColumn("page", F.col("o_orderkey").cast("int") + 1)
    long = long.select(*landed.capture_columns(t, landed.json_body(F.array(F.lit('{"basDt": 1}')), F.lit("1")), capture_id=F.lit("long"), num_of_rows=F.lit(1)))
    others = landed.intact(raw_from(read(spark, sf_dir, "customer"), key="c_custkey", basDt="'20240101'"), t)
    pages = stage_pages(parse_pages(long.unionByName(others), t), _folder(spark))
    return raw_rows(in_order(pages)).select("capture_id", "page", "pos", "ordinal")


@query("exact_whole_numbers", """
    select o_orderkey as k, case when o_orderkey = 0 then '0' else o_orderkey || '00000000000000000000' end as export_usd,
           case when o_orderkey % 4 = 0 then null else cast(-o_orderkey as varchar) end as import_usd from orders""")
def _(spark, sf_dir):
    """Numbers of 21 digits and more in a column that the table has as exact."""
    t = table("customs.item_trade").exact("export_usd", "import_usd")
    rows = raw_from(read(spark, sf_dir, "orders"), key="o_orderkey", year="'2024.01'", hsCode="'1'",
                    expDlr="concat(' ', o_orderkey, '00,000,000,000,000,000,000', if(o_orderkey % 2 = 0, '.00', ''))",
                    impDlr="if(o_orderkey % 4 = 0, concat('1', repeat('0', 38)), concat('-', o_orderkey))")
    text = lambda c: F.col(c).cast("string").alias(c)
    return clean(rows, t, keep=("k",)).select("k", text("export_usd"), text("import_usd"))


@query("rejects_past_38_digits", """
    select o_orderkey as k, 'export_usd' as missing, 'out of range' as reason from orders where o_orderkey % 5 = 0""")
def _(spark, sf_dir):
    """Of an exact column only numbers past 38 digits, or past 64 bits in scientific notation, are rejected."""
    t = table("customs.item_trade").exact("export_usd")
    rows = raw_from(read(spark, sf_dir, "orders"), key="o_orderkey", year="'2024.01'", hsCode="'1'",
                    expDlr="if(o_orderkey % 5 = 0, if(o_orderkey % 2 = 0, concat('1', repeat('0', 38)), '1E20'), repeat('9', 38))")
    return rejects(rows, t, keep=("k",)).select("k", "missing", "reason")


_NOWCAST = table("weather.nowcast")


def _cells(spark: SparkSession, sf_dir: str, some: str, at: int, value: str = "value") -> DataFrame:
    """Each user's events of a day as one fetch that says what it asked for; where ``some`` is not so, it
    found nothing."""
    events = read(spark, sf_dir, "events").withColumn("day", F.date_format("ts", "yyyyMMdd")).withColumn("cell", F.col("user_id"))
    rows = raw_from(events, baseDate="day", baseTime="'0500'", category="event_id", obsrValue=value, nx="cell", ny="127", wanted=some)
    item = F.when(F.col("raw")["wanted"] == "true", landed.json_item(F.map_filter("raw", lambda k, v: k != "wanted")))
    asked = {"base_date": F.col("raw")["baseDate"], "base_time": F.lit("0500"), "nx": F.col("raw")["nx"], "ny": F.lit("127")}
    pages = (rows.select(item.alias("item"), F.create_map(*(x for k, v in asked.items() for x in (F.lit(k), v))).alias("params"))
             .groupBy(F.to_json("params").alias("f"), F.map_entries("params").alias("entries")).agg(F.collect_list("item").alias("items"))
             .withColumns({"params": F.map_from_entries("entries"), "page": F.lit(1)}))
    body = landed.json_body(F.col("items"), F.size("items").cast("string"))
    return pages.select(*landed.capture_columns(
        _NOWCAST, body, fmt=F.lit("json"), params=F.col("params"), num_of_rows=F.lit(1_000_000),
        capture_id=F.concat(F.lit(f"{at}-"), "f"), captured_at=F.timestamp_seconds(F.lit(1_700_000_000 + at))))


@query("stored_refetch", """
    select strftime(ts, '%Y-%m-%d') as base_date, cast(event_id as varchar) as category, cast(user_id as bigint) as nx, 'a' as observed_value
    from events where user_id % 3 <> 0
    union all
    select strftime(ts, '%Y-%m-%d'), cast(event_id as varchar), cast(user_id as bigint), 'b'
    from events where user_id % 3 = 0 and user_id % 2 = 0 and event_id % 2 = 0""")
def _(spark, sf_dir):
    """Every cell of every day fetched; then a third of the cells anew, which find half of their rows
    or none: what they don't find any more goes."""
    folder = _folder(spark)
    refresh_table(_cells(spark, sf_dir, "true", 0, "'a'"), _NOWCAST.full_name, f"{folder}/t")
    again = _cells(spark, sf_dir, "user_id % 2 = 0 and event_id % 2 = 0", 1, "'b'").where(F.col("params")["nx"].cast("long") % 3 == 0)
    refresh_table(again, _NOWCAST.full_name, f"{folder}/t")
    return spark.read.parquet(f"{folder}/t").select("base_date", "category", "nx", "observed_value")


@query("fetch_pages_kept", """
    select strftime(o_orderdate, '%Y-%m-%d') as base_date, cast(o_orderkey as varchar) as fund_type
    from orders where o_orderdate >= date '1996-01-01' and o_orderdate < date '1998-01-01'""")
def _(spark, sf_dir):
    """One request answered twice from pages that are kept, more captures landed in between: only those
    are parsed."""
    t, folder = table("kofia.fund_net_asset"), _folder(spark)
    orders = read(spark, sf_dir, "orders")
    rows = raw_from(orders, key="o_orderkey", basDt="date_format(o_orderdate, 'yyyyMMdd')", ctg="o_orderkey", tstMthdCtg="'a'", nPptTotAmt="1")
    captures = landed.intact(rows, t)
    ask = dict(pages=f"{folder}/pages", begin="19960101", end="19971231")
    fetch(captures.where("hash(capture_id) % 2 = 0"), t.full_name, **ask)
    return fetch(captures, t.full_name, **ask).select("base_date", "fund_type")
