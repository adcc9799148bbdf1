import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from portalake.llm import urls
from portalake.llm.queries import QUERIES, SQL

ENTRIES = "pattern string, action string, since date"
PAGES = "page_id long, url string, fetched date, pattern string, key string, day string"
D = lambda m, d: dt.date(2024, m, d)


@pytest.fixture
def lists(llm):
    rows = [("Bad.Example.com", "block", D(1, 10)), ("bad.example.com", "allow", D(2, 10)), ("bad.example.com", "block", D(3, 10)),
            ("bad.example.com", "block", D(3, 10)), ("bad.example.com", "allow", D(3, 10)), ("example.org", "block", D(1, 1)),
            ("good.example.org/docs/", "allow", D(1, 5)), ("good.example.org/docs/secret", "block", D(1, 6)), (None, "block", D(1, 1)),
            ("x.net", None, D(1, 1)), ("x.net", "block", None), ("x.net", "odd", D(1, 1))]
    return llm.createDataFrame(rows, ENTRIES)


CASES = [("http://bad.example.com/a", D(1, 9), False), ("http://bad.example.com/a", D(1, 10), True), ("https://u:p@BAD.example.com:80/", D(2, 9), True),
         ("http://bad.example.com", D(2, 10), False), ("http://bad.example.com.?q=http://x/", D(3, 10), True), ("http://a.b.bad.example.com/", D(1, 20), True),
         ("http://notbad.example.com/", D(1, 20), False), ("http://good.example.org/", D(2, 1), True), ("http://good.example.org/docs", D(2, 1), False),
         ("http://good.example.org/docs/a?b#c", D(2, 1), False), ("http://good.example.org/docs/secret/x", D(2, 1), True), ("http://good.example.org/docsy", D(2, 1), True),
         ("http://good.example.org/docs/", D(1, 4), True), ("http://x.net/", D(2, 1), False), (None, D(1, 1), False), ("/relative", D(1, 1), False),
         ("", D(1, 1), False), ("http://", D(1, 1), False), ("http://example.org/" + "a/" * 3000, D(1, 1), True), ("http://example.org/x", None, False)]


def test_cases(llm, lists):
    rows = [(i, u, d, "p", "k", "d") for i, (u, d, _) in enumerate(CASES)]
    got = urls.judge(llm.createDataFrame([*rows, rows[1]], PAGES), lists).collect()
    assert sorted((r.id, r.blocked) for r in got) == sorted([(i, c[2]) for i, c in enumerate(CASES)] + [(1, True)])
    assert next(r for r in got if r.id == 10).pattern == "good.example.org/docs/secret"
    assert urls.judge(llm.createDataFrame(rows, PAGES), lists.limit(0)).where("blocked").count() == 0
    assert urls.judge(llm.createDataFrame([], PAGES), lists).count() == 0


def test_intervals(lists):
    got = [(r.action, r.since, r.until) for r in urls.intervals(lists).where("pattern = 'bad.example.com'").orderBy("since").collect()]
    assert got == [("block", D(1, 10), D(2, 10)), ("allow", D(2, 10), D(3, 10)), ("block", D(3, 10), None)]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables not here")
@pytest.mark.parametrize("name", ["op9_url_list", "op7_decontamination"])
def test_against_sql(llm, name):
    import duckdb
    db, sf = duckdb.connect(), "/root/testdata/sf0.001"
    for t in ("documents", "benchmark", "pages"):
        db.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    df = QUERIES[name](llm, sf)
    want = db.execute(SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(map(str, df.select(*columns).collect() and [tuple(r) for r in df.select(*columns).collect()])) == sorted(map(str, want.fetchall()))
    assert df.where(F.lit(False)).count() == 0
