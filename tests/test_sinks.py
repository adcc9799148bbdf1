import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from portalake import (CAPTURE_SCHEMA, fetch, read_bodies, read_captures, replace_table, rows_to_json, table,
                       typed_rows, upsert_table, write_captures, write_json)
from portalake.operators import filters
from portalake.streaming.ingest import stream_captures, upsert_batches


def _body(rows, total=None):
    items = ",".join(json.dumps(r, ensure_ascii=False) for r in rows)
    return ('{"response":{"header":{"resultCode":"00"},"body":{"items":{"item":[%s]},"totalCount":%d}}}'
            % (items, len(rows) if total is None else total)).encode()


def _capture(cid, rows, at=1, operation="getFundTotalNetEssetInfo", total=None, params=None):
    return (cid, "kofia", operation, "json", 1, 100, params or {}, dt.datetime(2025, 1, at), 200, None, _body(rows, total))


def _fund(day, kind, amount):
    return {"basDt": day, "ctg": kind, "tstMthdCtg": "공모", "nPptTotAmt": amount}


def _captures(spark, *rows):
    return spark.createDataFrame(list(rows), CAPTURE_SCHEMA)


KEEP = ("capture_id", "page", "captured_at", "params", "pos")


def test_captures_to_stored_table(spark, folder):
    t = table("kofia.fund_net_asset")
    first = _captures(spark, _capture("a", [_fund("20250105", "주식", 1), _fund("20250105", "채권", 2), _fund("20250203", "주식", 3)]),
                      _capture("bad", [_fund("20250105", "주식", 99)], total=5))
    write_captures(first, folder + "/captures")
    captures = read_captures(spark, folder + "/captures")
    upsert_table(typed_rows(captures, t.full_name, keep=KEEP), folder + "/t", t)
    second = _captures(spark, _capture("b", [_fund("20250105", "주식", 10), _fund("20250107", "주식", 4)], at=2))
    upsert_table(typed_rows(second, t.full_name, keep=KEEP), folder + "/t", t)
    upsert_table(typed_rows(second, t.full_name, keep=KEEP), folder + "/t", t)      # again: no change
    stored = spark.read.parquet(folder + "/t")
    assert sorted((r.base_date, r.fund_type, r.net_asset_total) for r in stored.collect()) == [
        ("2025-01-05", "주식", 10), ("2025-01-05", "채권", 2), ("2025-01-07", "주식", 4), ("2025-02-03", "주식", 3)]
    pruned = filters.date_range(stored, t, "20250201", "20250228")
    assert "PushedFilters: [IsNotNull(base_date), GreaterThanOrEqual(base_date,2025-02-01)" in \
        pruned._jdf.queryExecution().executedPlan().toString()


def test_wide_table_is_replaced_by_period(spark, folder):
    t = table("kofia.overseas_derivatives")
    op = t.operation
    row = lambda ym, v: {"basDt": ym, "trqu": v}
    for at, rows in ((1, [row("202501", 1), row("202501", 1), row("202502", 2)]), (2, [row("202501", 7)])):
        replace_table(typed_rows(_captures(spark, _capture(f"c{at}", rows, at, op)), t.full_name, keep=KEEP), folder + "/t", t)
    got = sorted((r.base_ym, r.trade_volume, r.row_id) for r in spark.read.parquet(folder + "/t").collect())
    assert got == [("2025-01", 7, "c2:1:0"), ("2025-02", 2, "c1:1:2")]
    with pytest.raises(ValueError):
        upsert_table(spark.read.parquet(folder + "/t"), folder + "/u", t)


def test_slices_of_a_period(spark, folder):
    t = table("kofia.overseas_derivatives")
    row = lambda c, v: {"basDt": "202501", "byNtnl": c, "trqu": v}
    for at, rows in ((1, [row("미국", 1), row("일본", 2)]), (2, [row("미국", 7)])):
        replace_table(typed_rows(_captures(spark, _capture(f"c{at}", rows, at, t.operation)), t.full_name, keep=KEEP),
                      folder + "/t", t, slices=["country"])
    got = sorted((r.country, r.trade_volume) for r in spark.read.parquet(folder + "/t").collect())
    assert got == [("미국", 7), ("일본", 2)]


def test_staged_pages_give_the_same_rows(spark, folder):
    captures = _captures(spark, _capture("a", [_fund("20250105", "주식", 1)]), _capture("b", [_fund("20250106", "주식", 2)], total=9))
    plain = typed_rows(captures, "kofia.fund_net_asset")
    staged = typed_rows(captures, "kofia.fund_net_asset", stage=folder + "/pages")
    assert plain.collect() == staged.collect() and plain.count() == 1


def test_folder_of_bodies(spark, folder):
    for cid, page, rows in (("x1", 1, [_fund("20250105", "주식", 1)]), ("x2", 1, [_fund("20250106", "채권", 2)])):
        path = f"{folder}/in/kofia/getFundTotalNetEssetInfo/{cid}"
        os.makedirs(path)
        with open(f"{path}/{page}.json", "wb") as f:
            f.write(_body(rows))
    captures = read_bodies(spark, f"file:{folder}/in", "json")
    rows = fetch(captures, "kofia.fund_net_asset", begin="20250106")
    assert [tuple(r) for r in rows.collect()] == [("2025-01-06", "채권", "공모", 2)]


def test_json_export(spark, folder):
    df = spark.createDataFrame([("가", None)], "a string, b string")
    assert rows_to_json(df).first().json == '{"a":"가","b":null}'
    write_json(df, folder + "/j")
    assert spark.read.text(folder + "/j").first().value == '{"a":"가","b":null}'


def test_stream_merges_complete_fetches(spark, folder):
    t = table("kofia.fund_net_asset")
    whole = [_capture("a", [_fund("20250105", "주식", 1)]), _capture("b", [_fund("20250105", "주식", 5)], at=3)]
    half = _capture("c", [_fund("20250106", "주식", 9)], at=4, total=2)
    rest = half[:4] + (2,) + half[5:10] + (_body([_fund("20250107", "주식", 8)], 2),)
    half = half[:5] + (1,) + half[6:]

    def run():
        q = (stream_captures(spark, folder + "/in").writeStream
             .foreachBatch(upsert_batches(t.full_name, folder + "/t", folder + "/landed"))
             .option("checkpointLocation", folder + "/cp").trigger(availableNow=True).start())
        assert q.awaitTermination(120)
        return sorted((r.base_date, r.net_asset_total) for r in spark.read.parquet(folder + "/t").collect())

    _captures(spark, *whole, half).write.parquet(folder + "/in")
    assert run() == [("2025-01-05", 5)]
    _captures(spark, rest).write.mode("append").parquet(folder + "/in")
    assert run() == [("2025-01-05", 5), ("2025-01-06", 9), ("2025-01-07", 8)]


def test_settled_rows_are_read_back(spark, folder):
    from portalake import settle
    df = settle(spark.range(5))
    assert df.count() == 5
    assert "FileScan parquet" in df._jdf.queryExecution().executedPlan().toString()


def test_upsert_reads_touched_months_only(spark, folder):
    from portalake.sinks.tables import stored_months, with_period
    t = table("kofia.fund_net_asset")
    rows = typed_rows(_captures(spark, _capture("a", [_fund("20250105", "주식", 1), _fund("20250203", "주식", 3)])), t.full_name, keep=KEEP)
    upsert_table(rows, folder + "/t", t)
    plan = stored_months(with_period(rows, t), folder + "/t", ["2025-02"])._jdf.queryExecution().executedPlan().toString()
    assert "part_month" in plan.split("PartitionFilters")[1].split("PushedFilters")[0] and "2025-02" in plan.split("PartitionFilters")[1]


def test_a_fetch_replaces_only_what_it_covers(spark, folder):
    t = table("weather.forecast")
    item = lambda day, nx, v: {"baseDate": day, "baseTime": "0500", "category": "TMP", "fcstDate": day, "fcstTime": "0600", "fcstValue": v, "nx": nx, "ny": 127}
    for i, (day, nx, v) in enumerate((("20250105", 60, "1"), ("20250106", 60, "2"), ("20250106", 61, "3"), ("20250106", 60, "4"))):
        c = ("c%d" % i, "weather", t.operation, "json", 1, 100, {}, dt.datetime(2025, 1, 7), 200, None, _body([item(day, nx, v)]))
        replace_table(typed_rows(_captures(spark, c), t.full_name, keep=KEEP), folder + "/t", t)
    got = sorted((r.base_date, r.nx, r.forecast_value) for r in spark.read.parquet(folder + "/t").collect())
    assert got == [("2025-01-05", 60, "1"), ("2025-01-06", 60, "4"), ("2025-01-06", 61, "3")]


def test_a_row_without_a_period_fails(spark, folder):
    t = table("midforecast.land")
    rows = spark.createDataFrame([("c", 1, None, {}, 0)], "capture_id string, page int, captured_at timestamp, params map<string,string>, pos int")
    rows = rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in t.schema])
    with pytest.raises(Exception, match="no period"):
        replace_table(rows, folder + "/t", t)


def test_bodies_below_an_odd_root(spark, folder):
    for name in ("1.json", "page2.json"):
        path = f"{folder}/in+x (1)/kofia/getFundTotalNetEssetInfo/x1"
        os.makedirs(path, exist_ok=True)
        with open(f"{path}/{name}", "wb") as f:
            f.write(_body([_fund("20250105", "주식", 1)]))
    rows = read_bodies(spark, f"{folder}/in+x (1)", "json").select("service", "operation", "capture_id", "page").collect()
    assert sorted(map(tuple, rows), key=str) == sorted([("kofia", "getFundTotalNetEssetInfo", "x1", 1), ("kofia", "getFundTotalNetEssetInfo", "x1", None)], key=str)


def test_two_tables_share_a_stage_root(spark, folder):
    a = typed_rows(_captures(spark, _capture("a", [_fund("20250105", "주식", 1)])), "kofia.fund_net_asset", stage=folder + "/s")
    b = typed_rows(_captures(spark, _capture("b", [{"basDt": "202501", "trqu": 1}], operation=table("kofia.overseas_derivatives").operation)),
                   "kofia.overseas_derivatives", stage=folder + "/s")
    assert a.count() == 1 and b.count() == 1


def test_filter_arguments(spark):
    df = spark.createDataFrame([], table("weather.forecast").schema)
    with pytest.raises(ValueError):
        filters.grid_forecast(df, 1, 2, base_date="20250101")
    with pytest.raises(ValueError):
        filters.bids_in_window(df, "2025", "2026")
    with pytest.raises(ValueError):
        filters.bids_in_window(df, "202501010000", "202501012359", basis="3")
    with pytest.raises(ValueError):
        filters.station_term(df, F.current_timestamp(), term="WEEK")
    no_date = spark.createDataFrame([], table("procurement.goods").schema)
    assert filters.date_range(no_date, table("procurement.goods"), "20250101") is no_date


def test_rows_of_one_region_are_split(spark, folder):
    """A month's region without other keys is dealt over several files."""
    from portalake.sinks.tables import with_period, write_table
    land = table("midforecast.land")
    rows = spark.range(4000).selectExpr("'11B00000' as region_code", "id as precip_prob_4am", "map('tmFc', '202401050600') as params", "timestamp_seconds(1700000000) as captured_at")
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        write_table(with_period(rows, land), f"{folder}/t", table=land)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    sizes = [r["count"] for r in spark.read.parquet(f"{folder}/t").groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 2000
