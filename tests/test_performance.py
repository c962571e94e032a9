from decimal import Decimal

from frames import branches, one, orders, rows, table

from stockrecon.operators import performance
from stockrecon.schemas import RESULTS


def suppliers(spark):
    return table(spark, "suppliers", [(1, "One"), (2, "Two"), (3, "Idle")])


def test_supplier_performance(spark):
    placed = orders(
        spark,
        (1, 1, 1, 1, "2025-01-05", "2025-01-03", 10, 10),
        (2, 1, 1, 1, "2025-01-05", "2025-01-05", 10, 5),
        (3, 1, 1, 1, "2025-01-05", "2025-01-09", 100, 100),
        (4, 1, 1, 2, "2025-01-05", "2025-01-06", 3, 2),
    )
    found = performance.supplier_performance(placed, suppliers(spark))
    assert rows(found) == [
        (1, "One", 3, 1, 66.67, 95.83, 0.67),
        (2, "Two", 1, 1, 0.0, 66.67, 1.0),
    ]


def health(spark, recon, phantom=(), lost=(), ids=(1, 2, 3, 4)):
    return performance.branch_inventory_health(
        branches(spark, *ids),
        spark.createDataFrame(list(recon), "branch_id bigint, stock_difference bigint"),
        spark.createDataFrame(list(phantom), "branch_id bigint"),
        spark.createDataFrame(
            [(b, Decimal(r), Decimal(p)) for b, r, p in lost],
            "branch_id bigint, estimated_lost_revenue decimal(18,2), estimated_lost_gross_profit decimal(18,2)",
        ),
    )


def test_health_sums_and_rank(spark):
    found = health(
        spark,
        [(1, 0), (1, -4), (1, 2), (2, 5), (3, 1), (3, 0)],
        [(1,), (1,)],
        [(1, "10.00", "1.00"), (1, "0.50", "0.25"), (2, "10.50", "3.00")],
    )
    assert found.columns == RESULTS["branch_inventory_health"].names
    assert rows(found.drop("branch_name", "region")) == [
        (1, 3, 2, 66.67, 6, 2, Decimal("10.50"), Decimal("1.25"), 1),
        (2, 1, 1, 100.0, 5, 0, Decimal("10.50"), Decimal("3.00"), 2),
        (3, 2, 1, 50.0, 1, 0, Decimal("0.00"), Decimal("0.00"), 3),
    ]


def test_full_tie_shares_rank_and_leaves_gap(spark):
    found = health(spark, [(1, 1), (2, 1), (3, 0)])
    assert rows(found, "branch_id", "risk_rank") == [(1, 1), (2, 1), (3, 3)]


def test_branch_without_snapshots_is_absent(spark):
    assert one(health(spark, [(4, 0)]), "branch_id", "snapshots") == (4, 1)
