from frames import branches, day, movements, orders, products, rows, snapshots

from stockrecon.operators import copies, ledger, reconcile


def reconciled(spark, stock, moved):
    return reconcile.inventory_reconciliation(
        snapshots(spark, *stock), branches(spark), products(spark), ledger.daily_movements(movements(spark, *moved))
    )


PICK = ["snapshot_date", "previous_recorded_stock", "net_movement", "expected_closing_stock", "stock_difference", "reconciliation_status"]


def test_first_day_with_and_without_opening(spark):
    recon = reconciled(
        spark,
        [(1, 1, "2025-01-01", 10), (1, 2, "2025-01-01", 10)],
        [(1, 1, "2025-01-01 06:00:00", "INITIAL_STOCK", 10, None)],
    )
    assert rows(recon, "product_id", *PICK[1:]) == [
        (1, None, 10, 10, 0, "Reconciled"),
        (2, None, 0, 0, 10, "Recorded stock exceeds ledger"),
    ]


def test_previous_row_jumps_a_gap_and_error_is_not_carried(spark):
    recon = reconciled(
        spark,
        [(1, 1, "2025-01-01", 0), (1, 1, "2025-01-02", 5), (1, 1, "2025-01-04", 4), (2, 1, "2025-01-03", 0)],
        [(1, 1, "2025-01-03 09:00:00", "SALE", 3, None), (1, 1, "2025-01-04 09:00:00", "SALE", 2, None)],
    )
    assert rows(recon.where("branch_id = 1"), *PICK) == [
        (day("2025-01-01"), None, 0, 0, 0, "Reconciled"),
        (day("2025-01-02"), 0, 0, 0, 5, "Recorded stock exceeds ledger"),
        (day("2025-01-04"), 5, -2, 3, 1, "Recorded stock exceeds ledger"),
    ]


def test_issue_causes(spark):
    stock = [(1, 1, "2025-01-01", 0), (1, 1, "2025-01-02", 0), (1, 1, "2025-01-03", 8), (1, 1, "2025-01-04", 2),
             (1, 1, "2025-01-05", 40), (1, 1, "2025-01-06", 40), (1, 1, "2025-01-07", 43)]
    copy = (1, 1, "2025-01-02 07:00:00", "DELIVERY", 12, "SUP-1")
    netted = (1, 1, "2025-01-06 07:00:00", "SALE", 5, "SALE-1")
    moved = [copy, copy, netted, netted, (1, 1, "2025-01-06 08:00:00", "DELIVERY", 10, "SUP-9"),
             (1, 1, "2025-01-07 08:00:00", "DELIVERY", 1, "SUP-8")]
    placed = [(2, 1, 1, 1, "2025-01-03", "2025-01-03", 8, 8), (3, 1, 1, 1, "2025-01-07", "2025-01-07", 2, 2)]
    recon = reconciled(spark, stock, moved)
    issues = reconcile.reconciliation_issues(recon, copies.duplicate_days(movements(spark, *moved)), orders(spark, *placed))
    assert rows(issues, "snapshot_date", "stock_difference", "duplicate_movement_count", "issue_severity", "probable_issue") == [
        (day("2025-01-02"), -24, 1, "High", "Duplicate inventory movement"),
        (day("2025-01-03"), 8, 0, "Medium", "Missing delivery movement"),
        (day("2025-01-04"), -6, 0, "Medium", "Possible shrinkage or missing outflow"),
        (day("2025-01-05"), 38, 0, "Critical", "Possible unrecorded inflow or count error"),
        (day("2025-01-07"), 2, 0, "Low", "Possible unrecorded inflow or count error"),
    ]


def test_duplicate_with_surplus_stock_is_no_duplicate_issue(spark):
    copy = (1, 1, "2025-01-01 07:00:00", "SALE", 2, "SALE-1")
    recon = reconciled(spark, [(1, 1, "2025-01-01", 0)], [copy, copy])
    issues = reconcile.reconciliation_issues(recon, copies.duplicate_days(movements(spark, copy, copy)), orders(spark))
    assert rows(issues, "stock_difference", "duplicate_movement_count", "probable_issue") == [
        (4, 1, "Possible unrecorded inflow or count error")
    ]


def test_carried_stock_comes_before_the_first_new_snapshot_only(spark):
    old = snapshots(spark, (1, 1, "2025-01-01", 9), (1, 1, "2025-01-02", 7), (1, 2, "2025-01-02", None), (2, 2, "2025-01-01", 3))
    new = snapshots(spark, (1, 1, "2025-01-05", None), (1, 1, "2025-01-06", 4), (1, 2, "2025-01-05", 1), (2, 1, "2025-01-05", 6), (2, 1, "2025-01-07", 5))
    found = reconcile.previous_stock(new, reconcile.last_stock(old))
    assert found.columns == [*new.columns, "previous_recorded_stock"]
    assert rows(found, "branch_id", "product_id", "snapshot_date", "recorded_closing_stock", "previous_recorded_stock") == [
        (1, 1, day("2025-01-05"), None, 7),
        (1, 1, day("2025-01-06"), 4, None),
        (1, 2, day("2025-01-05"), 1, None),
        (2, 1, day("2025-01-05"), 6, None),
        (2, 1, day("2025-01-07"), 5, 6),
    ]
