"""Fetches whose pages arrive over several batches, late, twice or never."""

import datetime as dt
import os

import pytest

from portalake import table
from portalake.streaming.ingest import stream_captures, upsert_batches
from tests.test_sinks import _body, _captures, _fund

FUND = table("kofia.fund_net_asset")


def page(cid, n, day, amount, total, at):
    return (cid, "kofia", FUND.operation, "json", n, 100, {}, dt.datetime(2025, 1, at), 200, None, _body([_fund(day, f"{cid}{n}", amount)], total))


@pytest.fixture
def stream(spark, folder):
    """Lands captures, runs the stream until it has taken them, and gives the stored rows."""
    def land(*captures, patience="10 days"):
        _captures(spark, *captures).coalesce(1).write.mode("append").parquet(folder + "/in")
        q = (stream_captures(spark, folder + "/in").writeStream.foreachBatch(upsert_batches(FUND.full_name, folder + "/t", folder + "/landed", patience))
             .option("checkpointLocation", folder + "/cp").trigger(availableNow=True).start())
        assert q.awaitTermination(180) and q.exception() is None
        if not os.path.isdir(folder + "/t"):
            return []
        return sorted((r.fund_type, r.net_asset_total) for r in spark.read.parquet(folder + "/t").collect())
    land.folder = folder
    land.ended = lambda: {(r.capture_id, r.status) for r in spark.read.parquet(folder + "/landed/ended").collect()}
    land.kept = lambda what: sorted(x for x in os.listdir(f"{folder}/landed/{what}") if not x.startswith("."))
    return land


def test_pages_over_batches_late_repeated_and_dropped(stream):
    assert stream(page("a", 2, "20250105", 2, 3, 1), page("b", 1, "20250105", 1, 1, 1)) == [("b1", 1)]
    assert stream(page("a", 3, "20250105", 3, 3, 2), page("x", 1, "20250105", 9, 2, 2)) == [("b1", 1)]
    # The first page comes last. A page again, alike, counts once.
    assert stream(page("a", 1, "20250105", 1, 3, 3), page("a", 2, "20250105", 2, 3, 1)) == [("a1", 1), ("a2", 2), ("a3", 3), ("b1", 1)]
    # Pages of a fetch that has ended, alike or not, change nothing; another body of an open one refuses it.
    rows = stream(page("b", 1, "20250105", 77, 1, 4), page("c", 1, "20250105", 1, 2, 4), page("c", 1, "20250105", 5, 2, 4))
    assert rows == [("a1", 1), ("a2", 2), ("a3", 3), ("b1", 1)] and {("b", "complete"), ("b", "late"), ("c", "repeated"), ("a", "complete")} <= stream.ended()
    # x never ends: after ten days without a page it is given up, and a page that comes after that is late.
    stream(page("d", 1, "20250105", 4, 1, 20))
    assert ("x", "timed out") in stream.ended()
    assert ("x2", 9) not in stream(page("x", 2, "20250105", 9, 2, 21)) and ("x", "late") in stream.ended()
    assert stream.kept("state") == ["4", "5"]


def test_cost_does_not_grow_with_history(stream, spark):
    for i in range(5):
        stream(page(f"f{i}", 1, "20250105", i, 1, 1 + i))
    # All have ended: only the last batch's pages, and the last two states.
    assert stream.kept("pages") == ["batch=4"] and stream.kept("state") == ["3", "4"]
    state = spark.read.parquet(f"{stream.folder}/landed/state/4").groupBy("kind").count().collect()
    assert {r["kind"]: r["count"] for r in state} == {"done": 5, "clock": 1}
    # Two weeks on, ids that ended before the time of patience are forgotten as well.
    stream(page("g", 1, "20250105", 1, 1, 20))
    state = spark.read.parquet(f"{stream.folder}/landed/state/5").groupBy("kind").count().collect()
    assert {r["kind"]: r["count"] for r in state} == {"done": 1, "clock": 1}


def test_a_batch_run_again_is_harmless(spark, folder):
    sink = upsert_batches(FUND.full_name, folder + "/t", folder + "/landed")
    batches = [_captures(spark, page("a", 1, "20250105", 1, 2, 1)), _captures(spark, page("a", 2, "20250105", 2, 2, 2), page("b", 1, "20250105", 3, 1, 2))]
    for i in (0, 0, 1, 1):
        sink(batches[i], i)
    assert sorted((r.fund_type, r.net_asset_total) for r in spark.read.parquet(folder + "/t").collect()) == [("a1", 1), ("a2", 2), ("b1", 3)]
