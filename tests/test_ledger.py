from decimal import Decimal

from frames import at, cancellations, day, movements, orders, products, branches, rows, sales, table

from stockrecon.operators import ledger
from stockrecon.operators.series import with_dims


def test_all_types_on_one_day(spark):
    kinds = ["INITIAL_STOCK", "DELIVERY", "POSITIVE_ADJUSTMENT", "SALE", "WASTE", "NEGATIVE_ADJUSTMENT"]
    moved = movements(spark, *[(1, 1, f"2025-01-01 0{n}:00:00", k, 2**n, None) for n, k in enumerate(kinds)])
    assert rows(ledger.daily_movements(moved)) == [(1, 1, day("2025-01-01"), 7, 56, -49)]


def test_outflow_only_and_branches_apart(spark):
    moved = movements(
        spark,
        (1, 1, "2025-01-01 09:00:00", "SALE", 3, None),
        (2, 1, "2025-01-01 09:00:00", "DELIVERY", 4, None),
        (1, 1, "2025-01-02 09:00:00", "WASTE", 1, None),
    )
    assert rows(ledger.daily_movements(moved)) == [
        (1, 1, day("2025-01-01"), 0, 3, -3),
        (1, 1, day("2025-01-02"), 0, 1, -1),
        (2, 1, day("2025-01-01"), 4, 0, 4),
    ]


def test_unknown_type_takes_stock_away(spark):
    moved = movements(spark, (1, 1, "2025-01-01 09:00:00", "LOST", 3, None))
    assert rows(ledger.daily_movements(moved)) == [(1, 1, day("2025-01-01"), 0, 0, -3)]


def test_daily_sales(spark):
    sold = sales(
        spark,
        (1, 1, "2025-01-01 09:00:00", 1, "0.10"),
        (1, 1, "2025-01-01 23:59:59", 2, "0.20"),
        (1, 1, "2025-01-02 00:00:00", 4, "0.40"),
    )
    assert rows(ledger.daily_sales(sold)) == [
        (1, 1, day("2025-01-01"), 3, Decimal("0.30")),
        (1, 1, day("2025-01-02"), 4, Decimal("0.40")),
    ]


def test_cancelled_by_day(spark):
    refused = cancellations(
        spark,
        (1, 1, "2025-01-01 09:00:00", 1, "OUT_OF_STOCK"),
        (1, 1, "2025-01-01 10:00:00", 2, "SYSTEM_SHOWED_AVAILABLE"),
        (1, 1, "2025-01-01 11:00:00", 4, "SYSTEM_SHOWED_AVAILABLE"),
    )
    assert rows(ledger.cancelled_by_day(refused)) == [(1, 1, day("2025-01-01"), 7)]
    assert rows(ledger.cancelled_by_day(refused, "SYSTEM_SHOWED_AVAILABLE")) == [(1, 1, day("2025-01-01"), 6)]


def test_delivery_days(spark):
    placed = orders(
        spark,
        (1, 1, 1, 1, "2025-01-02", "2025-01-03", 5, 5),
        (2, 1, 1, 1, "2025-01-03", "2025-01-03", 5, 5),
    )
    assert rows(ledger.delivery_days(placed)) == [(1, 1, day("2025-01-03"), 2)]


def test_with_dims_drops_unknown(spark):
    sold = table(spark, "sales", [(1, 1, 1, at("2025-01-01 09:00:00"), 1, None), (2, 9, 1, None, 1, None), (3, 1, 9, None, 1, None)])
    named = with_dims(sold, branches(spark), products(spark))
    assert rows(named, "sale_id", "branch_name", "sku") == [(1, "Branch 1", "SKU-1")]
