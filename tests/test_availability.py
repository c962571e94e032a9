from decimal import Decimal

from frames import branches, cancellations, day, products, rows, snapshots

from stockrecon.operators import availability

SHOWN, OUT = "SYSTEM_SHOWED_AVAILABLE", "OUT_OF_STOCK"


def test_phantom(spark):
    stock = snapshots(
        spark, (1, 1, "2025-01-01", 3), (1, 1, "2025-01-02", 0), (1, 1, "2025-01-03", 3), (1, 2, "2025-01-01", 9)
    )
    refused = cancellations(
        spark,
        (1, 1, "2025-01-01 09:00:00", 1, SHOWN),
        (1, 1, "2025-01-01 19:00:00", 2, SHOWN),
        (1, 1, "2025-01-02 09:00:00", 2, SHOWN),
        (1, 1, "2025-01-03 09:00:00", 2, OUT),
        (1, 2, "2025-01-05 09:00:00", 2, SHOWN),
    )
    found = availability.phantom_inventory(stock, refused, branches(spark), products(spark))
    assert rows(found, "product_id", "snapshot_date", "cancelled_quantity", "directly_observed_lost_revenue") == [
        (1, day("2025-01-01"), 3, Decimal("6.00"))
    ]


def test_stockout_days(spark):
    stock = snapshots(
        spark, (1, 1, "2025-01-01", 0), (1, 1, "2025-01-02", 4), (1, 1, "2025-01-03", 4), (1, 1, "2025-01-04", 4)
    )
    refused = cancellations(spark, (1, 1, "2025-01-02 09:00:00", 1, SHOWN), (1, 1, "2025-01-03 09:00:00", 2, OUT))
    days = availability.stockout_days(stock, refused, branches(spark), products(spark))
    assert rows(days, "stockout_date", "recorded_closing_stock", "cancelled_quantity") == [
        (day("2025-01-01"), 0, 0),
        (day("2025-01-02"), 4, 1),
        (day("2025-01-03"), 4, 2),
    ]


def periods(spark, *stock, refused=()):
    days = availability.stockout_days(
        snapshots(spark, *stock), cancellations(spark, *refused), branches(spark), products(spark)
    )
    return rows(availability.stockout_periods(days), "branch_id", "stockout_start", "stockout_end", "stockout_days", "cancelled_quantity")


def test_periods(spark):
    assert periods(
        spark,
        (1, 1, "2024-02-28", 0), (1, 1, "2024-02-29", 0), (1, 1, "2024-03-01", 0),
        (1, 1, "2024-03-02", 1), (1, 1, "2024-03-03", 0), (1, 1, "2024-03-05", 0),
        (2, 1, "2024-02-29", 0),
        refused=[(1, 1, "2024-02-29 09:00:00", 2, OUT), (1, 1, "2024-03-01 09:00:00", 3, OUT)],
    ) == [
        (1, day("2024-02-28"), day("2024-03-01"), 3, 5),
        (1, day("2024-03-03"), day("2024-03-03"), 1, 0),
        (1, day("2024-03-05"), day("2024-03-05"), 1, 0),
        (2, day("2024-02-29"), day("2024-02-29"), 1, 0),
    ]


def test_period_over_month_and_year(spark):
    assert periods(spark, (1, 1, "2024-12-31", 0), (1, 1, "2025-01-01", 0)) == [
        (1, day("2024-12-31"), day("2025-01-01"), 2, 0)
    ]


def test_both_views_keep_touched_snapshots_only(spark):
    days = [f"2025-01-0{n}" for n in range(1, 8)]
    stock = snapshots(spark, *[(b, p, d, 0 if (b, d) == (1, days[0]) else 4) for b in (1, 2) for p in (1, 2) for d in days])
    stock = stock.union(stock.where(f"snapshot_date < '{days[2]}'")).unionByName(snapshots(spark, (None, 1, days[0], 0), (1, 1, None, 3)))
    refused = cancellations(
        spark,
        *[(1, 1, f"{d} 09:00:00", n, SHOWN) for n, d in enumerate(days[:3])],
        (2, 2, f"{days[5]} 09:00:00", 2, OUT),
        (2, 2, f"{days[6]} 09:00:00", 0, SHOWN),
        (None, 1, f"{days[0]} 09:00:00", 1, SHOWN),
    )
    found = availability.touched(stock, refused)
    assert found.columns == stock.columns and found.count() == 10 < stock.count()
    dims = (branches(spark), products(spark))
    for view in (availability.phantom_inventory, availability.stockout_days):
        of_all, of_few = view(stock, refused, *dims), view(found, refused, *dims)
        assert sorted(map(str, of_few.collect())) == sorted(map(str, of_all.collect())) != []
