"""What a request reads, parses and stages."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from portalake import fetch, read_captures, table, typed_rows, write_captures
from portalake.operators.requests import Request, coverage, of_captures
from portalake.sources.pages import layer_folder, stored_pages, update_pages
from tests.test_sinks import _body, _capture, _captures, _fund

NOW = table("weather.nowcast")


def cell(cid, nx, params, at=1, day="20250105", n=2, total=None):
    rows = [{"baseDate": day, "baseTime": "0500", "category": f"T{i}", "obsrValue": str(i), "nx": nx, "ny": 127} for i in range(n)]
    return (cid, "weather", NOW.operation, "json", 1, 100, params, dt.datetime(2025, 1, at, 9), 200, None, _body(rows, total))


def staged(spark, folder):
    pages = [spark.read.parquet(p) for p in glob.glob(folder + "/pages-*")]
    return sum(p.count() for p in pages), sum(p.agg(F.sum(F.size("found"))).first()[0] or 0 for p in pages)


def test_captures_that_parameters_rule_out_are_not_parsed(spark, folder):
    asked = lambda nx: {"nx": str(nx), "ny": "127", "base_date": "20250105", "base_time": "0500"}
    captures = _captures(spark, *(cell(f"c{nx}", nx, asked(nx)) for nx in (60, 61, 62)), cell("d", 60, asked(60) | {"base_date": "20250106"}, day="20250106"))
    got = fetch(captures, NOW.full_name, stage=folder + "/a", nx=60, ny=127, base_date="20250105", base_time="0500")
    assert got.count() == 2 and staged(spark, folder + "/a") == (1, 2)
    none = fetch(captures, NOW.full_name, stage=folder + "/b", nx=99, ny=127)
    assert none.count() == 0 and staged(spark, folder + "/b") == (0, 0)
    # Without parameters nothing is ruled out, and rows that aren't asked for are not staged.
    plain = _captures(spark, *(cell(f"c{nx}", nx, {}) for nx in (60, 61, 62)))
    assert fetch(plain, NOW.full_name, stage=folder + "/c", nx=61, ny=127, base_date="20250105", base_time="0500").count() == 2
    assert staged(spark, folder + "/c") == (3, 2)
    assert fetch(plain, NOW.full_name, stage=folder + "/d", nx=99, ny=127, base_date="20250105", base_time="0500").count() == 0
    assert staged(spark, folder + "/d") == (3, 0)


def test_places_of_rows_and_refused_fetches_are_kept(spark, folder):
    rows = [_fund("20250105", "a", 1), _fund("20250301", "b", 2), _fund("20250302", "c", 3)]
    captures = _captures(spark, _capture("whole", rows), _capture("short", rows, total=9))
    got = fetch(captures, "kofia.fund_net_asset", begin="20250301")
    assert sorted(r.fund_type for r in got.collect()) == ["b", "c"]


@pytest.mark.parametrize("first, last, want", [("20250103", "20250104", {"a", "x"}), ("202501", "202501", {"a", "b", "x"}), ("20250201", None, {"c", "x"}),
                                               (None, "20250105", {"a", "b", "x"}), (None, None, {"a", "b", "c", "x"})])
def test_spans_that_overlap(spark, first, last, want):
    span = lambda a, b: {"beginBasDt": a, "endBasDt": b}
    captures = _captures(spark, _capture("a", [], params=span("20250101", "20250104")), _capture("b", [], params=span("20250105", "20250120")),
                         _capture("c", [], params=span("20250201", "20250220")), _capture("x", []))
    test = of_captures(table("kofia.fund_net_asset"), Request(first=first, last=last))
    assert {r.capture_id for r in captures.where(test).collect()} == want


def test_a_layer_parses_each_body_once(spark, folder):
    t = table("kofia.fund_net_asset")
    write_captures(_captures(spark, _capture("a", [_fund("20250105", "a", 1)]), _capture("b", [_fund("20250106", "b", 2)], at=2)), folder + "/in")
    captures = read_captures(spark, folder + "/in")
    ask = lambda df, **more: sorted(r.fund_type for r in fetch(df, t.full_name, pages=folder + "/pages", **more).collect())
    assert ask(captures, begin="20250101") == ["a", "b"]
    files = set(glob.glob(layer_folder(folder + "/pages", t) + "/*/*.parquet"))
    assert ask(captures, begin="20250106") == ["b"] and update_pages(captures, folder + "/pages", t) == 0
    assert set(glob.glob(layer_folder(folder + "/pages", t) + "/*/*.parquet")) == files, "nothing was parsed or written"
    # What is known is told from identities alone: the bodies are not read for it.
    plan = captures.where(F.col("operation") == t.operation).select("capture_id", "page", "captured_at", "fingerprint")._jdf.queryExecution().executedPlan().toString()
    assert "body" not in plan.split("ReadSchema")[1]
    # New landings, one of them another body of a known page: only they are parsed; the fetch is then refused.
    write_captures(_captures(spark, _capture("c", [_fund("20250107", "c", 3)], at=20), _capture("a", [_fund("20250105", "z", 1)], at=21)), folder + "/in")
    captures = read_captures(spark, folder + "/in")
    assert update_pages(captures, folder + "/pages", t) == 2 and ask(captures, begin="20250101") == ["b", "c"]
    assert ask(captures, begin="20250101", captured=("2025-01-03", None)) == ["c", "z"], "landings of that time alone"
    assert stored_pages(spark, folder + "/pages", t).count() == 4


def test_a_layer_takes_captures_without_fingerprints_or_times(spark, folder):
    t = table("kofia.fund_net_asset")
    rows = [_capture("a", [_fund("20250105", "a", 1)]), _capture("b", [_fund("20250106", "b", 2)])[:7] + (None, 200, None, _body([_fund("20250106", "b", 2)]))]
    captures = _captures(spark, *rows, rows[0])
    for _ in range(2):
        got = typed_rows(captures, t.full_name, pages=folder + "/pages")
        assert sorted(r.fund_type for r in got.collect()) == ["a", "b"]
    assert update_pages(captures, folder + "/pages", t) == 0
    assert fetch(captures.limit(0), "kofia.cma_status", pages=folder + "/pages").count() == 0


def test_time_of_capture_reaches_the_scan(spark, folder):
    write_captures(_captures(spark, _capture("a", [])), folder + "/in")
    test = of_captures(table("kofia.fund_net_asset"), Request(), ("2025-01-03", "2025-02-01"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = read_captures(spark, folder + "/in").where(test)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(captured_at" in plan and "LessThanOrEqual(captured_at" in plan


def test_coverage_is_read_from_parameters(spark):
    asked = {"nx": "60", "ny": "127", "base_date": "20250105", "base_time": "0500"}
    rows = [("a", dt.datetime(2025, 1, 6), asked), ("a", dt.datetime(2025, 1, 5), asked), ("b", None, {"nx": "60"}), ("c", None, {})]
    df = spark.createDataFrame(rows, "capture_id string, captured_at timestamp, params map<string,string>")
    got = [r.asDict() for r in coverage(df, NOW).collect()]
    assert got == [{"capture_id": "a", "first": "20250105", "last": "20250105", "base_time": "0500", "nx": "60", "ny": "127", "began": dt.datetime(2025, 1, 5)}]
    assert coverage(df, table("airquality.by_sido")).count() == 0
