"""Bodies with their request records, the order of rows, and numbers past 64 bits."""

import datetime as dt
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from portalake import clean, fetch, in_order, parse_pages, raw_rows, read_bodies, rejects, table, with_records
from tests.test_sinks import _body, _capture, _captures, _fund


def test_records_beside_bodies(spark, folder):
    t = table("midforecast.land")
    for cid, region, time in (("a", "11B", "202501050600"), ("b", "11C", "202501051800"), ("c", "11D", None)):
        path = f"{folder}/in/midforecast/{t.operation}/{cid}"
        os.makedirs(path)
        with open(path + "/1.json", "wb") as f:
            f.write(_body([{"regId": region, "rnSt4Am": 30}]))
        if time:
            with open(path + "/1.request.json", "w") as f:
                json.dump({"params": {"tmFc": time, "regId": region}, "captured_at": "2025-01-05T07:00:00Z", "num_of_rows": 10}, f, indent=1)
    captures = read_bodies(spark, f"{folder}/in", "json", records=True)
    got = {r.capture_id: r for r in captures.collect()}
    assert set(got) == {"a", "b", "c"} and got["a"].captured_at == dt.datetime(2025, 1, 5, 7) and got["a"].num_of_rows == 10
    assert got["c"].params == {} and got["c"].num_of_rows == 1000 and got["a"].http_status == 200
    rows = fetch(captures, t.full_name, region_code="11B", base_time="202501050600")
    assert [(r.region_code, r.precip_prob_4am) for r in rows.collect()] == [("11B", 30)]
    assert fetch(captures, t.full_name, region_code="11D", base_time="202501050600").count() == 0


def test_the_latest_record_counts(spark):
    captures = _captures(spark, _capture("a", []), _capture("b", []))
    rows = [("kofia", captures.first().operation, "a", 1, {"x": str(at)}, dt.datetime(2025, 1, at), 500 + at) for at in (2, 9, 4)]
    records = spark.createDataFrame(rows, "service string, operation string, capture_id string, page int, params map<string,string>, captured_at timestamp, http_status int")
    got = {r.capture_id: (r.params, r.http_status) for r in with_records(captures, records).collect()}
    assert got == {"a": ({"x": "9"}, 509), "b": ({}, 200)}


def test_rows_have_their_place_in_the_fetch(spark):
    def page(n, k):
        c = list(_capture("a", [_fund("20250105", f"{n}{i}", 1) for i in range(k)], total=7))
        c[4] = n
        return tuple(c)

    pages = parse_pages(_captures(spark, page(2, 3), page(1, 2), page(1, 2), page(3, 0), page(4, 2), _capture("b", [_fund("20250105", "x", 1)])))
    rows = raw_rows(in_order(pages.dropDuplicates(["capture_id", "page"])))
    got = sorted((r.capture_id, r.ordinal, r.raw["ctg"]) for r in rows.collect())
    assert got == [("a", i, c) for i, c in enumerate(["10", "11", "20", "21", "22", "40", "41"])] + [("b", 0, "x")]


def test_exact_numbers(spark):
    t = table("customs.item_trade").exact("export_usd")
    assert table(t) is t
    values = {"9" * 38: Decimal("9" * 38), "-9,223,372,036,854,775,809": Decimal(-9223372036854775809), "1" + "0" * 38: None, "12.0": Decimal(12), "1E3": Decimal(1000),
              "1E30": None, "3.8": None, "-": None, "0" * 50 + "7": Decimal(7)}
    raw = spark.createDataFrame([({"year": "202501", "hsCode": "1", "expDlr": v, "impDlr": "99999999999999999999"},) for v in values], "raw map<string,string>")
    got = [r.export_usd for r in clean(raw, t).collect()]
    assert got == list(values.values())
    reasons = [(r.missing, r.reason) for r in rejects(raw, t).collect()]
    assert len(reasons) == len(values) and sorted(set(reasons)) == [("export_usd", "out of range"), ("import_usd", "out of range")]
    assert sum(m == "export_usd" for m, _ in reasons) == 2
    with pytest.raises(ValueError):
        table("customs.item_trade").exact("item_name")
