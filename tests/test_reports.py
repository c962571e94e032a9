from decimal import Decimal

from frames import day, movements, one, orders, rows, snapshots, table
from pyspark.sql import functions as F

from stockrecon.operators import copies, integrity
from stockrecon.operators import reports as R

ISSUE = "branch_id bigint, product_id bigint, snapshot_date date, stock_difference bigint, issue_severity string, probable_issue string"
PHANTOM = "branch_id bigint, product_id bigint, snapshot_date date, directly_observed_lost_revenue decimal(18,2)"
LOST = "branch_id bigint, product_id bigint, stockout_date date, category string, estimated_lost_revenue decimal(18,2)"
SHRINK = "Possible shrinkage or missing outflow"


def issues(spark, *extra):
    d = day("2025-01-01")
    base = [(1, 1, d, -6, "Medium", SHRINK), (1, 2, d, 30, "Critical", "Missing delivery movement"), (2, 1, d, -7, "Medium", SHRINK)]
    return spark.createDataFrame([*base, *extra], ISSUE)


def test_mixes(spark):
    assert [tuple(r) for r in R.issue_mix(issues(spark)).collect()] == [
        (SHRINK, "Medium", 2, 13),
        ("Missing delivery movement", "Critical", 1, 30),
    ]
    assert [tuple(r) for r in R.cause_counts(issues(spark)).collect()] == [(SHRINK, 2), ("Missing delivery movement", 1)]
    assert [tuple(r) for r in R.severity_mix(issues(spark)).collect()] == [("Medium", 2), ("Critical", 1)]


def test_top_differences_ties_by_key(spark):
    tied = issues(spark, (0, 9, day("2025-01-01"), 7, "Medium", "x"))
    assert [(r.branch_id, r.absolute_difference) for r in R.top_differences(tied, 3).collect()] == [(1, 30), (0, 7), (2, 7)]
    assert [r.stock_difference for r in R.largest_differences(tied).collect()] == [30, 7, -7, -6]


def test_top_phantom_ties_by_key(spark):
    d = day("2025-01-01")
    cases = spark.createDataFrame([(2, 1, d, Decimal("5")), (1, 1, d, Decimal("5")), (3, 1, d, Decimal("9"))], PHANTOM)
    assert [r.branch_id for r in R.top_phantom(cases, 2).collect()] == [3, 1]


def test_category_lost_revenue(spark):
    d = day("2025-01-01")
    lost = spark.createDataFrame([(1, 1, d, "A", Decimal("0.10")), (1, 1, d, "B", Decimal("5")), (2, 1, d, "A", Decimal("0.20"))], LOST)
    assert [tuple(r) for r in R.category_lost_revenue(lost).collect()] == [("B", Decimal("5.00")), ("A", Decimal("0.30"))]


def test_filters(spark):
    frame = issues(spark)
    assert R.filter_in(frame, "issue_severity", ["Critical"]).count() == 1
    assert R.filter_in(frame, "issue_severity", []).count() == R.filter_in(frame, "issue_severity", None).count() == 3
    with_null = issues(spark, (1, 1, None, 1, None, None))
    assert [r[0] for r in R.filter_options(with_null, "issue_severity").collect()] == ["Critical", "Medium"]
    assert R.select_present(frame, ["branch_id", "nowhere"]).columns == ["branch_id"]


def test_order_for_chart_puts_missing_last(spark):
    frame = spark.createDataFrame([(1, None), (2, 5), (3, 4)], "id int, v int")
    assert [r.id for r in R.order_for_chart(frame, "v", False).collect()] == [3, 2, 1]
    assert [r.id for r in R.order_for_chart(frame, "v", True).collect()] == [2, 3, 1]


def test_recall(spark):
    d, e = day("2025-01-01"), day("2025-01-02")
    known = table(spark, "known_issues", [("A", 1, 1, d), ("A", 1, 1, e), ("A", 1, 2, d), ("B", 1, 1, d), ("C", 1, 1, d), ("C", 1, 1, d)])
    keys = "issue_type string, branch_id bigint, product_id bigint, issue_date date"
    detected = spark.createDataFrame([("A", 1, 1, d), ("A", 1, 2, d), ("A", 9, 9, d), ("C", 1, 1, d), ("Z", 1, 1, d)], keys)
    assert rows(R.recall(known, detected)) == [("A", 3, 2, 66.67), ("B", 1, 0, 0.0), ("C", 2, 2, 100.0)]


def test_recall_rounds_half_to_even(spark):
    d = day("2025-01-01")
    known = table(spark, "known_issues", [("A", 1, n, d) for n in range(800)])
    detected = spark.createDataFrame([("A", 1, 1, d)], known.schema)
    assert one(R.recall(known, detected), "detection_rate") == (0.12,)


def test_detectors(spark):
    d = day("2025-01-01")
    copy = (1, 1, "2025-01-01 07:00:00", "DELIVERY", 5, "SUP-1")
    phantom = spark.createDataFrame([(3, 3, d, Decimal("1"))], PHANTOM)
    placed = orders(spark, (1, 1, 1, 1, "2025-01-01", "2025-01-01", 5, 5), (2, 2, 2, 1, "2025-01-01", "2025-01-01", 5, 5))
    moved = movements(spark, copy, copy, copy)
    unbooked = integrity.orders_without_movement(placed, moved)
    found = R.detected_issues(phantom, copies.duplicate_days(moved), unbooked, issues(spark))
    assert rows(found) == [
        ("Duplicate inventory movement", 1, 1, d),
        ("Missing delivery movement", 2, 2, d),
        ("Phantom inventory", 3, 3, d),
        (SHRINK, 1, 1, d),
        (SHRINK, 2, 1, d),
    ]


def test_executive_kpis_on_empty(spark):
    empty = [spark.createDataFrame([], schema) for schema in (ISSUE, PHANTOM, LOST)]
    found = R.executive_kpis(snapshots(spark), empty[0], empty[1], copies.duplicate_days(movements(spark)), empty[2])
    assert rows(found) == [(0, 0, 0, 0, Decimal("0.00"))]


def test_dashboard_filter_touches_issues_only(spark):
    d = day("2025-01-01")
    phantom = spark.createDataFrame([(3, 3, d, Decimal("1"))], PHANTOM)
    lost = spark.createDataFrame([(1, 1, d, "A", Decimal("2.50"))], LOST)
    rates = spark.createDataFrame([(90.0, 50.0), (100.0, 100.0)], "detection_rate double, on_time_delivery_rate double")
    found = R.dashboard_kpis(issues(spark), phantom, lost, rates, rates, ["Medium"])
    assert rows(found) == [(2, 1, Decimal("2.50"), 95.0, 75.0)]


def test_one_row(spark):
    frame = spark.range(3)
    assert rows(R.one_row(n=(frame, F.count("id")), top=(frame, F.max("id")))) == [(3, 2)]
