import pytest

from portalake import TABLES, Field, Table, clean, project, rejects, table


def test_inventory():
    assert len(TABLES) == 29
    services = {}
    for t in TABLES.values():
        services.setdefault(t.service, []).append(t)
    assert {s: len(ts) for s, ts in services.items()} == {
        "weather": 3, "airquality": 2, "holidays": 5, "realestate": 4, "midforecast": 2,
        "procurement": 4, "customs": 1, "kofia": 8}
    assert all(t.fmt == ("json" if t.service == "kofia" else "xml") for t in TABLES.values())


@pytest.mark.parametrize("name,columns,keys,wide,date", [
    ("weather.forecast", 8, 5, True, "base_date"), ("weather.nowcast", 6, 3, True, "base_date"),
    ("airquality.by_sido", 23, 2, True, None), ("airquality.by_station", 23, 2, True, None),
    ("holidays.solar_terms", 5, 2, False, "date"), ("realestate.apt_trade", 18, 7, True, "deal_date"),
    ("realestate.apt_trade_detail", 30, 7, True, "deal_date"), ("realestate.apt_rent", 23, 7, True, "deal_date"),
    ("realestate.apt_presale", 17, 7, True, "deal_date"), ("midforecast.land", 23, 1, True, None),
    ("midforecast.temperature", 15, 1, True, None), ("procurement.construction", 16, 2, True, None),
    ("customs.item_trade", 8, 2, False, "period"), ("kofia.market_funds", 7, 1, False, "base_date"),
    ("kofia.credit_balance", 9, 1, False, "base_date"), ("kofia.fund_net_asset", 4, 3, False, "base_date"),
    ("kofia.cma_status", 6, 3, False, "base_date"), ("kofia.dls_dlb", 6, 4, False, "base_ym"),
    ("kofia.els_elb", 6, 4, False, "base_ym"), ("kofia.trust_scale", 6, 5, False, "base_ym"),
    ("kofia.overseas_derivatives", 12, 10, True, "base_ym")])
def test_shapes(name, columns, keys, wide, date):
    t = table(name)
    assert (len(t.columns), len(t.key_columns), t.wide, t.date_column) == (columns, keys, wide, date)


def test_half_day_columns():
    assert table("midforecast.land").columns[:5] == [
        "region_code", "precip_prob_4am", "precip_prob_4pm", "precip_prob_5am", "precip_prob_5pm"]
    assert table("midforecast.land").columns[-1] == "sky_10"
    assert table("midforecast.temperature").columns[1:4] == ["temp_min_4", "temp_max_4", "temp_min_5"]


def test_bad_declarations():
    with pytest.raises(ValueError, match="column"):
        Table("s", "t", "op", (Field("a", "x", "text"), Field("b", "x", "int")))
    with pytest.raises(ValueError, match="token"):
        Table("s", "t", "op", (Field("a", "x", "text"), Field("a", "y", "int")))
    with pytest.raises(ValueError, match="kind"):
        Field("a", "x", "blob")
    with pytest.raises(ValueError, match="unknown table"):
        table("weather.tides")


def _rows(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "raw map<string,string>")


def test_composite_key_drops_missing_keys(spark):
    t = table("kofia.fund_net_asset")
    full = {"basDt": "20250102", "ctg": " 주식형 ", "tstMthdCtg": "공모", "nPptTotAmt": "9,007,199,254,740,993", "x": "y"}
    rows = _rows(spark, full, {**full, "ctg": "nan"}, {**full, "basDt": "20250230"}, {**full, "nPptTotAmt": "-"})
    got = [tuple(r) for r in clean(rows, t).collect()]
    assert got == [("2025-01-02", "주식형", "공모", 9007199254740993), ("2025-01-02", "주식형", "공모", None)]
    assert clean(rows, t).columns == t.columns
    assert sorted(r.missing for r in rejects(rows, t).collect()) == ["base_date", "fund_type"]
    assert project(rows, t).count() == 4


def test_wide_table_keeps_missing_dimensions(spark):
    t = table("weather.nowcast")
    rows = _rows(spark, {"baseDate": "20250102", "category": "", "nx": "60"}, {"baseDate": "", "nx": "60"})
    got = clean(rows, t).collect()
    assert len(got) == 1 and got[0].category is None and got[0].nx == 60 and got[0].ny is None


def test_schema_metadata_survives(spark):
    t = table("customs.item_trade")
    out = clean(_rows(spark, {"year": "2025.03", "hsCode": "0101"}), t).schema
    assert out["period"].metadata == {"token": "year", "kind": "date_ym", "key": True}
    assert [f.dataType for f in out] == [f.dataType for f in t.schema]


def test_only_needed_tokens_are_read(spark, folder):
    t = table("procurement.goods")
    (spark.range(3).selectExpr(*[f"cast(id as string) as {c}" for c in t.source_tokens])
     .selectExpr(f"struct({', '.join(t.source_tokens)}) as raw").write.parquet(folder + "/rows"))
    plan = clean(spark.read.parquet(folder + "/rows"), t).select("notice_no")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<raw:struct<bidNtceNo:string>>" in plan


def test_wide_tables_are_typed_outside_whole_stage_code(spark):
    """The plan doesn't hang on the session's limit for generated methods."""
    for name, apart in (("realestate.apt_trade_detail", True), ("kofia.market_funds", False)):
        plan = clean(spark.createDataFrame([({"a": "b"},)], "raw map<string,string>"), table(name))._jdf.queryExecution().executedPlan().toString()
        typed = [line for line in plan.splitlines() if "Project" in line][0]
        assert ("*(" not in typed.split("Project")[0]) == apart


def test_patterns_of_a_wide_table_are_few(spark):
    """Texts are trimmed without a pattern, and the contract date, which the filter names again, by one."""
    rows = spark.createDataFrame([({"a": "b"},)], "raw map<string,string>")
    plan = clean(rows, table("realestate.apt_trade_detail"))._jdf.queryExecution().optimizedPlan()
    texts = [e.toString() for e in _expressions(plan) if "raw" in e.toString() and " AS _" in e.toString()]
    assert len(texts) == 30
    assert [t.count("RLIKE") for t in texts if "dealYear" not in t] == [0] * 29
    assert [t.count("RLIKE") for t in texts if "dealYear" in t] == [1]


def _expressions(plan):
    nodes = [plan]
    while nodes:
        node = nodes.pop()
        nodes += [node.children().apply(i) for i in range(node.children().size())]
        yield from (node.expressions().apply(i) for i in range(node.expressions().size()))
