import pytest

from portalake import complete_only, page_audit, refused

SCHEMA = ("capture_id string, page int, num_of_rows int, status string, code string, message string, "
          "total long, n int")


def _pages(spark, **captures):
    rows = []
    for cid, pages in captures.items():
        for page, total, n, *status in pages:
            s = status[0] if status else "ok"
            rows.append((cid, page, 10, s, "00", s, total, n))
    return spark.createDataFrame(rows, SCHEMA)


SCENARIOS = {
    # pages as (number, total, rows[, status]) -> status, rows, last page
    "total": ([(1, 15, 10), (2, 15, 5)], ("complete", 15, 2)),
    "short_page_with_total": ([(1, 15, 5), (2, 15, 10)], ("complete", 15, 2)),
    "stops_at_total": ([(1, 5, 5), (2, 5, 5)], ("complete", 5, 1)),
    "no_total_then_empty": ([(1, None, 10), (2, None, 0)], ("complete", 10, 2)),
    "no_total_short": ([(1, None, 10), (2, None, 3), (3, None, 10)], ("complete", 13, 2)),
    "empty_too_early": ([(1, 30, 10), (2, 30, 0)], ("truncated", 10, 2)),
    "too_many": ([(1, 15, 10), (2, 15, 10)], ("duplicated", 20, 2)),
    "no_data": ([(1, 0, 0, "no_data")], ("complete", 0, 1)),
    "no_data_after_rows": ([(1, None, 10), (2, 0, 0, "no_data")], ("duplicated", 10, 2)),
    "total_changes": ([(1, 99, 10), (2, 20, 10)], ("complete", 20, 2)),
    "fault": ([(1, 20, 10), (2, None, 0, "auth")], ("auth", 10, 2)),
    "fault_after_the_end": ([(1, 10, 10), (2, None, 0, "auth")], ("complete", 10, 1)),
    "gap": ([(1, 30, 10), (3, 30, 10)], ("incomplete", 20, 3)),
    "no_first_page": ([(2, 10, 10)], ("incomplete", 10, 2)),
    "open_end": ([(1, 30, 10)], ("incomplete", 10, 1)),
    "repeated": ([(1, 20, 10), (1, 20, 10)], ("repeated", 10, 1)),
    "long": ([(p, 25000, 10) for p in range(1, 2501)], ("complete", 25000, 2500)),
    "long_open": ([(p, None, 10) for p in range(1, 2002)], ("incomplete", 20010, 2001)),
    "gap_in_a_later_block": ([(p, 30000, 10) for p in range(1, 2400) if p != 1500], ("incomplete", 15000, 1501)),
    "null_page": ([(None, 10, 10)], ("incomplete", 10, None)),
    "zero_page": ([(0, 20, 10), (1, 20, 10), (2, 20, 10)], ("incomplete", 10, None)),
    "negative_page": ([(-3, 10, 10)], ("incomplete", 10, None)),
}


def test_scenarios(spark):
    pages = _pages(spark, **{k: v[0] for k, v in SCENARIOS.items()})
    got = {r.capture_id: (r.status, r.rows, r.last_page) for r in page_audit(pages).collect()}
    assert got == {k: v[1] for k, v in SCENARIOS.items()}


def test_no_capture_vanishes(spark):
    pages = _pages(spark, **{k: v[0] for k, v in SCENARIOS.items()})
    audit = page_audit(pages)
    assert audit.count() == len(SCENARIOS)
    assert refused(audit).count() + audit.where("status = 'complete'").count() == len(SCENARIOS)
    assert [(r.status, r.message) for r in audit.where("capture_id = 'null_page'").collect()] == [("incomplete", "a page without a number")]


def test_copies_count_once_if_alike(spark):
    schema = SCHEMA + ", fingerprint long, items array<int>"
    rows = [(c, p, 10, "ok", "00", "ok", 20, 10, h, [1]) for c, p, h in
            (("alike", 1, 7), ("alike", 1, 7), ("alike", 2, 8), ("other", 1, 7), ("other", 1, 9), ("other", 2, 8))]
    pages = spark.createDataFrame(rows, schema)
    audit = page_audit(pages)
    assert {r.capture_id: (r.status, r.rows) for r in audit.collect()} == {"alike": ("complete", 20), "other": ("repeated", 10)}
    assert sorted((r.capture_id, r.page) for r in complete_only(pages, audit).collect()) == [("alike", 1), ("alike", 2)]


def test_no_window_over_a_capture(spark):
    plan = page_audit(_pages(spark, a=[(1, 10, 10)]))._jdf.queryExecution().optimizedPlan().toString()
    over_pages = [line for line in plan.splitlines() if "Window" in line and "page" in line.split("windowspec")[0]]
    assert all("block" in line for line in over_pages)


def test_all_or_nothing(spark):
    pages = _pages(spark, **{k: v[0] for k, v in SCENARIOS.items()})
    audit = page_audit(pages)
    kept = {(r.capture_id, r.page) for r in complete_only(pages, audit).collect()}
    want = {(k, p[0]) for k, (ps, (status, _, last)) in SCENARIOS.items() for p in ps
            if status == "complete" and p[0] is not None and p[0] <= last}
    assert kept == want
    assert {r.capture_id for r in refused(audit).collect()} == {
        k for k, v in SCENARIOS.items() if v[1][0] != "complete"}


def test_audit_reads_only_narrow_columns(spark, folder):
    from portalake import CAPTURE_SCHEMA, parse_pages, stage_pages
    staged = stage_pages(parse_pages(spark.createDataFrame([], CAPTURE_SCHEMA)), folder + "/pages")
    plan = page_audit(staged)._jdf.queryExecution().executedPlan().toString()
    assert "items" not in plan.split("ReadSchema")[1]
