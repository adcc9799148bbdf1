"""Stored tables: months opened, row groups read, and what a refetch replaces."""

import datetime as dt
import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from portalake import clean, discard, refresh_table, replace_table, select_rows, session, table, typed_rows, write_table
from portalake.sinks.tables import ASKED_PERIOD, with_period
from tests.test_sinks import KEEP, _body, _captures



def lineage():
    return {"capture_id": F.lit("c"), "page": F.lit(1), "pos": F.col("id").cast("int"), "captured_at": F.lit(dt.datetime(2025, 3, 1)),
            "params": F.create_map(F.lit("tmFc"), F.lit("202502010600"))}


def stored(spark, folder, name, n=60, **tokens):
    """A table of n rows, one a day from January on, stored."""
    t = table(name)
    day = F.expr("date_add(date'2025-01-01', cast(id as int))")
    raw = F.create_map(*(x for k, v in tokens.items() for x in (F.lit(k), (v(day) if callable(v) else F.lit(v)).cast("string"))))
    rows = clean(spark.range(n).select("id", raw.alias("raw")).withColumns(lineage()), t, keep=KEEP)
    write_table(with_period(rows, t), folder + "/t", table=t)
    return spark.read.parquet(folder + "/t")


ymd = lambda d: F.date_format(d, "yyyyMMdd")
CASES = {
    "kofia.market_funds": ({"basDt": ymd}, {"begin": "20250201", "end": "20250205"}, 5, "2025-02"),
    "kofia.trust_scale": ({"basYm": lambda d: F.date_format(d, "yyyyMM"), "bzds": lambda d: F.date_format(d, "dd"), "tstCtg": "a", "kind": "b", "iqBs": "c"},
                          {"begin": "202502", "end": "20250228"}, 28, "2025-02"),
    "holidays.holidays": ({"locdate": ymd, "dateName": "x"}, {"year": 2025, "month": 2}, 28, "2025-02"),
    "realestate.apt_trade": ({"dealYear": "2025", "dealMonth": F.month, "dealDay": F.dayofmonth, "sggCd": "11110"}, {"region_code": "11110", "deal_ym": "202502"}, 28, "2025-02"),
    "procurement.goods": ({"bidNtceDt": lambda d: F.date_format(d, "yyyy-MM-dd 09:00:00")}, {"begin": "202502010000", "end": "202502030859"}, 2, "2025-02"),
    "airquality.by_station": ({"stationName": "s", "dataTime": lambda d: F.date_format(d, "yyyy-MM-dd 09:00")},
                              {"station": "s", "data_term": "DAILY", "as_of": lambda: F.lit(dt.datetime(2025, 2, 10, 9))}, 2, "2025-02"),
    "weather.nowcast": ({"baseDate": ymd, "baseTime": "0500", "nx": "60", "ny": "127"}, {"nx": 60, "ny": 127, "base_date": "20250210", "base_time": "0500"}, 1, "2025-02"),
    "customs.item_trade": ({"year": lambda d: F.date_format(d, "yyyy.MM"), "hsCode": "85"}, {"hs_code": "85", "begin": "202502", "end": "202502"}, 28, "2025-02"),
    "midforecast.land": ({"regId": "11B"}, {"region_code": "11B", "base_time": "202502010600"}, 60, "2025-02"),
}


@pytest.mark.parametrize("name", CASES)
def test_requests_open_the_months_they_name(spark, folder, name):
    tokens, arguments, n, month = CASES[name]
    rows = select_rows(stored(spark, folder, name, **tokens), name, **{k: v() if callable(v) else v for k, v in arguments.items()})
    plan = rows._jdf.queryExecution().executedPlan().toString()
    chosen = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "part_month" in chosen and month in chosen, chosen
    assert rows.count() == n


def test_a_window_of_openings_opens_all_months(spark, folder):
    rows = stored(spark, folder, "procurement.goods", bidNtceDt=lambda d: F.date_format(d, "yyyy-MM-dd 09:00"), opengDt=lambda d: F.date_format(F.date_add(d, 40), "yyyy-MM-dd 09:00"))
    assert select_rows(rows, "procurement.goods", begin="202502100000", end="202502112359", query_basis="2").count() == 2


def test_a_month_of_request_parameters_is_not_taken_for_that_of_dates(spark, folder):
    t = table("weather.nowcast")
    raw = F.create_map(F.lit("baseDate"), F.lit("20250105"), F.lit("baseTime"), F.lit("0500"), F.lit("nx"), F.lit("60"), F.lit("ny"), F.lit("127"))
    rows = clean(spark.range(2).select("id", raw.alias("raw")).withColumns(lineage()), t, keep=KEEP)
    replace_table(rows, folder + "/t", t, period_param="tmFc")
    got = spark.read.parquet(folder + "/t")
    assert ASKED_PERIOD in got.columns and "part_month" not in got.columns
    assert select_rows(got, t.full_name, nx=60, ny=127, base_date="20250105", base_time="0500").count() == 2


def groups_with(folder, column, value):
    """Row groups of a stored table that may hold a value, and all."""
    may = total = 0
    for f in glob.glob(folder + "/*/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = next(i for i in range(meta.num_columns) if meta.schema.column(i).path == column)
        for i in range(meta.num_row_groups):
            s = meta.row_group(i).column(at).statistics
            total += 1
            may += s.min <= value <= s.max
    return may, total


def test_rows_of_a_month_stand_by_what_requests_name(spark, folder):
    """Half of all rows in one region; regions arrive in turn. Row groups of some kilobytes."""
    t = table("realestate.apt_trade")
    region = F.when(F.col("id") % 2 == 0, 11110).otherwise(11111 + F.col("id") % 97)
    raw = F.create_map(*(x for k, v in {"dealYear": F.lit(2025), "dealMonth": F.lit(1), "dealDay": 1 + F.col("id") % 28, "sggCd": region, "aptNm": F.sha2(F.col("id").cast("string"), 256)}.items()
                         for x in (F.lit(k), v.cast("string"))))
    rows = with_period(clean(spark.range(0, 20_000, 1, 8).select("id", raw.alias("raw")).withColumns(lineage()), t, keep=KEEP), t)
    small = {"parquet.block.size": "65536", "parquet.page.size": "8192", "parquet.page.size.row.check.min": "10"}
    write_table(rows, folder + "/plain", options=small)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_table(rows, folder + "/laid", table=t, options=small)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    plain, laid = groups_with(folder + "/plain", "region_code", "11150"), groups_with(folder + "/laid", "region_code", "11150")
    assert plain[0] == plain[1] > 10 and laid[1] > 10 and laid[0] <= 2
    sizes = sorted(pq.ParquetFile(f).metadata.num_rows for f in glob.glob(folder + "/laid/*/*.parquet"))
    assert len(sizes) >= 4 and sizes[-1] <= 0.45 * 20_000, "a hot region is split"
    assert spark.read.parquet(folder + "/laid").where("region_code = '11150'").count() == spark.read.parquet(folder + "/plain").where("region_code = '11150'").count() > 0


# --- what a refetch replaces ------------------------------------------------------------------

NOW = table("weather.nowcast")


def cell(cid, day, nx, values, at, params=True, total=None):
    rows = [{"baseDate": day, "baseTime": "0500", "category": k, "obsrValue": v, "nx": nx, "ny": 127} for k, v in values.items()]
    asked = {"nx": str(nx), "ny": "127", "base_date": day, "base_time": "0500"} if params else {}
    return (cid, "weather", NOW.operation, "json", 1, 100, asked, dt.datetime(2025, 3, at), 200, None, _body(rows, total))


def refreshed(spark, folder, *captures, **more):
    refresh_table(_captures(spark, *captures), NOW.full_name, folder + "/t", **more)
    return sorted((r.base_date, r.nx, r.category, r.observed_value) for r in spark.read.parquet(folder + "/t").collect())


def test_an_empty_or_smaller_refetch_removes_what_it_covers(spark, folder):
    first = [cell("a", "20250105", 60, {"T": "1", "U": "2"}, 1), cell("b", "20250105", 61, {"T": "3"}, 1), cell("c", "20250206", 60, {"T": "4"}, 1)]
    assert len(refreshed(spark, folder, *first)) == 4
    # One row less; the other cell and day stay.
    assert refreshed(spark, folder, cell("d", "20250105", 60, {"T": "9"}, 2)) == [("2025-01-05", 60, "T", "9"), ("2025-01-05", 61, "T", "3"), ("2025-02-06", 60, "T", "4")]
    # None at all; an incomplete fetch, and one that doesn't say what it asked for, remove nothing.
    left = [("2025-01-05", 61, "T", "3"), ("2025-02-06", 60, "T", "4")]
    assert refreshed(spark, folder, cell("e", "20250105", 60, {}, 3), cell("f", "20250105", 61, {}, 3, total=5), cell("g", "20250206", 60, {}, 3, params=False)) == left
    # The last row of a month: its folder goes.
    assert refreshed(spark, folder, cell("h", "20250206", 60, {}, 4), pages=folder + "/pages") == left[:1]
    assert glob.glob(folder + "/t/part_month=*") == [folder + "/t/part_month=2025-01"]
    # Landed together, a fetch that began later decides.
    assert refreshed(spark, folder, cell("i", "20250107", 60, {"T": "5"}, 5), cell("j", "20250107", 60, {}, 6), cell("k", "20250108", 60, {}, 5), cell("l", "20250108", 60, {"T": "6"}, 6)) == \
        [("2025-01-05", 61, "T", "3"), ("2025-01-08", 60, "T", "6")]


def test_months_that_a_request_spans_are_covered(spark, folder):
    t = table("kofia.overseas_derivatives")

    def capture(cid, rows, at, begin, end):
        items = [{"basDt": ym, "byNtnl": c, "trqu": 1} for ym, c in rows]
        return (cid, "kofia", t.operation, "json", 1, 100, {"beginBasDt": begin, "endBasDt": end}, dt.datetime(2025, 9, at), 200, None, _body(items))

    def run(*captures):
        refresh_table(_captures(spark, *captures), t.full_name, folder + "/t")
        return sorted((r.base_ym, r.country) for r in spark.read.parquet(folder + "/t").collect())

    assert len(run(capture("a", [("202411", "x"), ("202501", "x"), ("202502", "x"), ("202504", "x")], 1, "202411", "202504"))) == 4
    assert run(capture("b", [("202502", "y")], 2, "202412", "202503")) == [("2024-11", "x"), ("2025-02", "y"), ("2025-04", "x")]


def test_a_keyed_table_is_merged_and_nothing_else_is_left(spark, folder):
    from tests.test_sinks import _capture, _fund
    scratch = session.shared_folder(spark).split(":", 1)[-1]
    held = set(os.listdir(scratch)) if os.path.isdir(scratch) else set()
    for at, amount in ((1, 5), (2, 6)):
        refresh_table(_captures(spark, _capture(f"c{at}", [_fund("20250105", "a", amount)], at=at)), "kofia.fund_net_asset", folder + "/t")
    assert [r.net_asset_total for r in spark.read.parquet(folder + "/t").collect()] == [6]
    rows = typed_rows(_captures(spark, _capture("d", [_fund("20250105", "a", 7)])), "kofia.fund_net_asset")
    assert len(set(os.listdir(scratch)) - held) == 1 and rows.count() == 1, "what a result still reads stays"
    discard(rows)
    assert set(os.listdir(scratch)) - held == set()
