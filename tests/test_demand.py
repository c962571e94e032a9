from decimal import Decimal

from frames import branches, cancellations, day, products, rows, sales, snapshots

from stockrecon.operators import availability, demand, ledger


def lost(spark, stock, sold, refused=(), prices=(("1.00", "2.00"),)):
    goods = products(spark, *prices)
    days = availability.stockout_days(snapshots(spark, *stock), cancellations(spark, *refused), branches(spark), goods)
    return demand.lost_sales_estimate(days, ledger.daily_sales(sales(spark, *sold)), goods)


PICK = ["actual_units_sold", "expected_units", "estimated_lost_units", "estimated_lost_revenue", "estimated_lost_gross_profit"]


def test_four_weeks_missing_days_count_as_zero(spark):
    sold = [(1, 1, f"2025-01-{d:02d} 10:00:00", q, "0") for d, q in ((1, 100), (8, 4), (15, 3), (16, 50))]
    found = lost(spark, [(1, 1, "2025-01-22", 0)], sold)
    # 2025-01-22 looks back at 15, 8, 1 and the empty 25 December.
    assert rows(found, *PICK) == [(0, Decimal("26.75"), Decimal("26.75"), Decimal("53.50"), Decimal("26.75"))]


def test_first_weeks_still_divide_by_four(spark):
    found = lost(spark, [(1, 1, "2025-01-08", 0)], [(1, 1, "2025-01-01 10:00:00", 1, "0")])
    assert rows(found, *PICK[1:3]) == [(Decimal("0.25"), Decimal("0.25"))]


def test_other_branch_and_other_weekday_do_not_count(spark):
    sold = [(2, 1, "2025-01-01 10:00:00", 8, "0"), (1, 1, "2025-01-02 10:00:00", 8, "0"), (1, 1, "2024-12-04 10:00:00", 8, "0")]
    found = lost(spark, [(1, 1, "2025-01-08", 0)], sold)
    assert rows(found, *PICK[1:3]) == [(Decimal("0.00"), Decimal("0.00"))]


def test_cancelled_outweighs_and_never_negative(spark):
    sold = [(1, 1, "2025-01-01 10:00:00", 8, "0"), (1, 1, "2025-01-08 10:00:00", 5, "0")]
    refused = [(1, 1, "2025-01-08 11:00:00", 3, "OUT_OF_STOCK")]
    assert rows(lost(spark, [(1, 1, "2025-01-08", 1)], sold, refused), *PICK[:3]) == [
        (5, Decimal("2.00"), Decimal("3.00"))
    ]
    assert rows(lost(spark, [(1, 1, "2025-01-08", 0)], sold), *PICK[:3]) == [(5, Decimal("2.00"), Decimal("0.00"))]


def test_half_cent_rounds_up_once(spark):
    found = lost(spark, [(1, 1, "2025-01-08", 0)], [(1, 1, "2025-01-01 10:00:00", 1, "0")], prices=(("0.88", "9.10"),))
    # 0.25 x 9.10 = 2.275, 0.25 x 8.22 = 2.055
    assert rows(found, *PICK[3:]) == [(Decimal("2.28"), Decimal("2.06"))]


def test_lookback_days():
    assert demand.lookback_days() == [7, 14, 21, 28]


def test_demand_by_day(spark):
    sold = ledger.daily_sales(sales(spark, (1, 1, "2025-01-01 10:00:00", 2, "0"), (1, 1, "2025-01-08 10:00:00", 5, "0")))
    found = rows(demand.demand_by_day(sold).where("stockout_date <= '2025-01-15'"), "stockout_date", "actual_units_sold", "lookback_units")
    assert found == [(day("2025-01-01"), 2, None), (day("2025-01-08"), 5, 2), (day("2025-01-15"), None, 7)]
