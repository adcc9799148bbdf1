"""A few queries against their SQL on the smallest tables, and the contract of all of them."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import TABLES, rows_of

SF = "/root/testdata/sf0.001"
SOME = ["parse_int", "kofia_market_funds", "realestate_apt_rent", "clean_rejects", "bids_opened_in_window",
        "parse_json_envelope", "parse_xml_envelope", "page_audit", "page_audit_long", "complete_only", "rejects_out_of_range", "fetch_weather_forecast",
        "resolve_region", "latlon_grid", "latest_nowcast", "upsert_by_key", "replace_period"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not here")


def test_every_query_has_sql():
    from checks.registry import QUERIES
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())
    assert len(QUERIES) > 90


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", SOME)
def test_query(spark, name):
    import duckdb
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = queries()[name](spark, SF)
    result = db.execute(oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())
