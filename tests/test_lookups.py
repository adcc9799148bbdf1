import datetime as dt
import unicodedata

import pytest
from pyspark.sql import functions as F

from portalake import (districts_from_legal_codes, grid_cell, latest_announcement, resolve_land_zone,
                       resolve_named, resolve_region, resolve_temp_city)

DISTRICTS = [("강원특별자치도", "고성군", "51820"), ("경상남도", "고성군", "48820"), ("경기도", "수원시", "41110"),
             ("경기도", "수원시장안구", "41111"), ("서울특별시", "종로구", "11110"), ("서울특별시", "중구", "11140"),
             ("부산광역시", "중구", "26110"), ("충청남도", "천안시동남구", "44131"), ("대구광역시", "남구", "27200")]


@pytest.mark.parametrize("query,status,code", [
    ("종로구", "ok", "11110"), (unicodedata.normalize("NFD", "종로구"), "ok", "11110"), ("중구", "ambiguous", None),
    ("서울 중구", "ok", "11140"), ("경남 고성군", "ok", "48820"), ("경상남도 고성군", "ok", "48820"),
    ("장안구", "ok", "41111"), ("수원시 장안구", "ok", "41111"), ("경기도 수원시 장안구", "ok", "41111"),
    ("수원시장안구", "ok", "41111"), ("천안 남구", "none", None), ("남구", "ok", "27200"), ("", "none", None),
    ("  ", "none", None), (None, "none", None), ("없는구", "none", None), ("부산 종로구", "none", None)])
def test_region(spark, query, status, code):
    dim = spark.createDataFrame(DISTRICTS, "sido string, sigungu string, code string")
    row = resolve_region(spark.createDataFrame([(query,)], "query string"), dim).first()
    assert (row.status, row.code) == (status, code)


def test_region_candidates_and_strict(spark):
    dim = spark.createDataFrame(DISTRICTS, "sido string, sigungu string, code string")
    asked = spark.createDataFrame([("중구",), ("중구",), ("종로구",)], "query string")
    rows = resolve_region(asked, dim).collect()
    assert len(rows) == 3
    assert {tuple(r.candidates) for r in rows if r.candidates} == {("부산광역시 중구", "서울특별시 중구")}
    with pytest.raises(Exception, match="ambiguous"):
        resolve_region(asked, dim, strict=True).collect()


@pytest.mark.parametrize("query,status,code", [
    ("서울", "ok", "11B00000"), ("경상도", "ok", "11H00000"), ("경상", "ambiguous", None), ("", "ambiguous", None),
    (" 제주도 ", "ok", "11G00000"), ("달", "none", None)])
def test_land_zone(spark, query, status, code):
    row = resolve_land_zone(spark.createDataFrame([(query,)], "query string")).first()
    assert (row.status, row.code) == (status, code)


def test_names_against_brute_force(spark):
    names = [("고성", "a"), ("고성", "b"), ("고성(장전)", "c"), ("순천", "d"), ("순천시", "e"), ("서울", "f"), ("aaa", "g")]
    queries = ["고성", "순천", "천", "시", "(장", "a", "aa", "aaaa", "", "서울 ", "zz"]
    df = resolve_named(spark.createDataFrame([(q,) for q in queries], "query string"),
                       spark.createDataFrame(names, "name string, code string"))
    for r in df.collect():
        q = r.query.strip()
        hits = [n for n in names if n[0] == q] or [n for n in names if q in n[0]]
        assert r.status == ("none" if not hits else "ok" if len(hits) == 1 else "ambiguous")
        assert r.code == (hits[0][1] if len(hits) == 1 else None)
        assert (r.candidates or []) == (sorted(n for n, _ in hits) if len(hits) > 1 else [])
    assert resolve_temp_city(df.select("query"), spark.createDataFrame(names, "name string, code string")).count() == 11


def test_index_grows_with_the_names_and_queries_without_text_are_spread(spark):
    """A blank query among many names is counted, not listed; null queries don't meet in one task."""
    names = spark.range(3000).selectExpr("concat('place ', id, ' of the same length') as name", "cast(id as string) as code")
    queries = spark.range(0, 900, 1, 3).selectExpr("case id % 3 when 0 then '' when 1 then concat('place ', id, ' of  ') end as query")
    got = resolve_named(queries, names)
    rows = got.collect()
    assert len(rows) == 900
    for r in rows:
        if r.query is None:
            assert (r.status, r.code, r.candidates) == ("none", None, None)
        else:
            assert (r.status, r.candidates) == (("ambiguous", None) if r.query == "" else ("ok", None))
    assert [r.status for r in resolve_named(spark.createDataFrame([("",)], "query string"), names.limit(1)).collect()] == ["ok"]
    assert [r.status for r in resolve_named(spark.createDataFrame([("",), ("a",)], "query string"), names.limit(0)).collect()] == ["none", "none"]
    few = resolve_named(spark.createDataFrame([("place",)], "query string"), names, listed=2).first()
    assert (few.status, few.candidates) == ("ambiguous", None)


def test_a_query_meets_only_the_names_that_contain_it(spark):
    """Names whose neighbouring letters all queries share: no join puts out more rows than fit, whatever
    a query's length. Queries of more than sixteen letters, and some met twice, against brute force."""
    names = [(f"{i * 7919 % 3000}-{i % 300}", str(i)) for i in range(600)] + [("ab" * 20, "x"), ("ab" * 20, "x"), ("ab" * 12 + "c", "y"), ("가나" * 9 + "다", "z")]
    queries = [f"{i}-" for i in range(200)] + [f"{i}-{i}" for i in range(50)] + ["ab" * 10, "ab" * 12 + "c", "b" + "ab" * 19, "ab" * 30, "나" + "가나" * 8 + "다", "ba" * 8, "", "a", "0"]
    got = resolve_named(spark.createDataFrame([(q,) for q in queries], "query string"), spark.createDataFrame(names, "name string, code string"))
    for r in got.collect():
        hits = [n for n in names if n[0] == r.query] or [n for n in names if r.query in n[0]]
        assert (r.status, r.code) == (("none", None) if not hits else ("ok", hits[0][1]) if len(hits) == 1 else ("ambiguous", None))
        assert (r.candidates or []) == (sorted(n for n, _ in hits) if len(hits) > 1 else [])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_pair" not in plan and "_mark" in plan


def test_districts_from_the_public_code_list(spark):
    codes = [("1100000000", "서울특별시", True), ("1111000000", "서울특별시 종로구", True),
             ("1111010100", "서울특별시 종로구 청운동", True), ("4111000000", "경기도 수원시", True),
             ("4111100000", "경기도 수원시 장안구", True), ("4121000000", "경기도 옛시", False)]
    dim = districts_from_legal_codes(spark.createDataFrame(codes, "code string, name string, active boolean"))
    assert sorted(tuple(r) for r in dim.collect()) == [
        ("경기도", "수원시", "41110"), ("경기도", "수원시장안구", "41111"), ("서울특별시", "종로구", "11110")]


@pytest.mark.parametrize("lat,lon,cell", [
    (37.5714, 126.9658, (60, 127)), (35.1028, 129.0403, (97, 74)), (33.4996, 126.5312, (53, 38)),
    (36.3620, 127.3563, (67, 101)), (37.5714, 126.9658 + 720, (60, 127)), (90.0, 127.0, None), (-90.0, 127.0, None),
    (float("nan"), 127.0, None), (37.0, float("inf"), None), (37.0, float("nan"), None), (None, 127.0, None)])
def test_grid(spark, lat, lon, cell):
    got = spark.createDataFrame([(lat, lon)], "a double, b double").select(grid_cell(F.col("a"), F.col("b"))).first()[0]
    assert (tuple(got) if got else None) == cell


def test_grid_strict(spark):
    with pytest.raises(Exception, match="out of range"):
        spark.range(1).select(grid_cell(F.lit(95.0), F.lit(127.0), strict=True)).collect()


@pytest.mark.parametrize("operation,now,want", [
    ("forecast", "2025-06-01 08:15:00", "20250601 0800"), ("forecast", "2025-06-01 08:14:59", "20250601 0500"),
    ("forecast", "2025-06-01 02:14:00", "20250531 2300"), ("forecast", "2025-01-01 00:00:00", "20241231 2300"),
    ("forecast", "2025-06-01 23:59:59", "20250601 2300"), ("ultra_forecast", "2025-06-01 09:50:00", "20250601 0930"),
    ("ultra_forecast", "2025-06-01 09:49:59", "20250601 0830"), ("ultra_forecast", "2025-06-01 00:10:00", "20250531 2330"),
    ("nowcast", "2025-06-01 10:45:00", "20250601 1000"), ("nowcast", "2025-06-01 10:44:59", "20250601 0900"),
    ("nowcast", "2025-06-01 00:44:00", "20250531 2300")])
def test_announcements(spark, operation, now, want):
    wall = F.lit(now).cast("timestamp_ntz")
    instant = F.to_timestamp(F.lit(now + "+09:00"))
    row = spark.range(1).select(latest_announcement(wall, operation, wall_clock=True).alias("w"),
                                latest_announcement(instant, operation).alias("i")).first()
    assert f"{row.w.base_date} {row.w.base_time}" == want
    assert f"{row.i.base_date} {row.i.base_time}" == want


def test_unknown_operation():
    with pytest.raises(ValueError):
        latest_announcement(None, "tides")
