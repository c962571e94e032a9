"""One key holds a third of all rows: results stay whole and equal to plain loops."""

import random
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from frames import branches, products, rows, table

from stockrecon.operators import availability, copies, demand, integrity, ledger, performance, reconcile, reports

START = date(2025, 1, 1)
KINDS = ["DELIVERY", "POSITIVE_ADJUSTMENT", "SALE", "WASTE", "NEGATIVE_ADJUSTMENT"]


@pytest.fixture(scope="module")
def data(spark):
    """Series (1, 1) has a third of the facts, and one movement a third of those."""
    draw = random.Random(3)

    def series():
        return (1, 1) if draw.random() < 1 / 3 else (draw.randint(1, 3), draw.randint(1, 4))

    def moment(hours=24):
        return datetime(2025, 1, 1) + timedelta(days=draw.randint(0, 59), hours=draw.randint(0, hours - 1))

    moved = []
    for n in range(900):
        if n % 3 == 0:
            moved.append((n, 1, 1, datetime(2025, 1, 9, 7), "DELIVERY", 2, "SUP-1"))
        else:
            moved.append((n, *series(), moment(2), draw.choice(KINDS), draw.randint(1, 3), draw.choice([None, f"SUP-{n}"])))
    stock = [
        (n, b, p, START + timedelta(days=d), draw.choice([0, 0, draw.randint(1, 40)]))
        for n, (b, p, d) in enumerate((b, p, d) for b in (1, 2, 3) for p in (1, 2, 3, 4) for d in range(60) if draw.random() < 0.8)
    ]
    sold = [(n, *series(), moment(), draw.randint(1, 5), None) for n in range(600)]
    refused = [(n, *series(), moment(), draw.randint(1, 3), draw.choice(["OUT_OF_STOCK", "SYSTEM_SHOWED_AVAILABLE"])) for n in range(150)]
    placed = []
    for n in range(300):
        b, p = series()
        placed.append((n, b, p, 1 if draw.random() < 0.4 else draw.randint(2, 5), START, START + timedelta(days=3), START + timedelta(days=draw.randint(0, 59)), 9, draw.randint(1, 9)))
    raw = {"movements": moved, "snapshots": stock, "sales": sold, "cancellations": refused, "supplier_orders": placed}
    frames = {name: table(spark, name, content).repartition(5) for name, content in raw.items()}
    frames["branches"], frames["products"] = branches(spark, 1, 2, 3), products(spark, *[("1.05", "2.15")] * 4)
    return raw, frames


def daily(rows_, moment, value):
    sums = defaultdict(int)
    for row in rows_:
        sums[row[1], row[2], row[moment].date()] += value(row)
    return sums


def test_reconciliation_and_causes(data):
    raw, f = data
    inflow = daily(raw["movements"], 3, lambda r: r[5] if r[4] in KINDS[:2] else 0)
    net = daily(raw["movements"], 3, lambda r: r[5] if r[4] in KINDS[:2] else -r[5])
    groups = defaultdict(int)
    for row in raw["movements"]:
        groups[row[1], row[2], row[3], row[4], row[5], row[6] or ""] += 1
    surplus = defaultdict(int)
    for key, count in groups.items():
        surplus[key[0], key[1], key[2].date()] += count - 1
    delivered = {(r[1], r[2], r[6]) for r in raw["supplier_orders"]}
    expected, previous = [], {}
    for number, b, p, d, stock in sorted(raw["snapshots"], key=lambda r: (r[1], r[2], r[3])):
        gap = stock - previous.get((b, p), 0) - net[b, p, d]
        previous[b, p] = stock
        if gap < 0:
            cause = "Duplicate inventory movement" if surplus[b, p, d] else "Possible shrinkage or missing outflow"
        elif gap > 0:
            missing = (b, p, d) in delivered and not inflow[b, p, d]
            cause = "Missing delivery movement" if missing else "Possible unrecorded inflow or count error"
        else:
            continue
        expected.append((number, gap, surplus[b, p, d], cause))
    recon = reconcile.inventory_reconciliation(
        f["snapshots"], f["branches"], f["products"], ledger.daily_movements(f["movements"])
    )
    issues = reconcile.reconciliation_issues(recon, copies.duplicate_days(f["movements"]), f["supplier_orders"])
    picked = issues.select("snapshot_id", "stock_difference", "duplicate_movement_count", "probable_issue")
    assert sorted(map(tuple, picked.collect())) == sorted(expected)


def test_lost_sales(data):
    raw, f = data
    sold = daily(raw["sales"], 3, lambda r: r[4])
    refused = daily(raw["cancellations"], 3, lambda r: r[4])
    expected = []
    for _, b, p, d, stock in raw["snapshots"]:
        cancelled = refused.get((b, p, d), 0)
        if stock == 0 or cancelled:
            mean = sum(sold.get((b, p, d - timedelta(days=n)), 0) for n in (7, 14, 21, 28)) / 4
            actual = sold.get((b, p, d), 0)
            expected.append((b, p, d, actual, mean, max(cancelled, mean - actual, 0)))
    days = availability.stockout_days(f["snapshots"], f["cancellations"], f["branches"], f["products"])
    lost = demand.lost_sales_estimate(days, ledger.daily_sales(f["sales"]), f["products"])
    found = [
        (r.branch_id, r.product_id, r.stockout_date, r.actual_units_sold, float(r.expected_units), float(r.estimated_lost_units))
        for r in lost.collect()
    ]
    assert sorted(found) == sorted(expected)


def test_stockout_periods(data):
    raw, f = data
    refused = daily(raw["cancellations"], 3, lambda r: r[4])
    stock = {(b, p, d): s for _, b, p, d, s in raw["snapshots"]}
    days = {key for key, s in stock.items() if s == 0 or refused.get(key, 0)}
    expected = []
    for b, p, d in days:
        if (b, p, d - timedelta(days=1)) not in days:
            length = 1
            while (b, p, d + timedelta(days=length)) in days:
                length += 1
            run = [(b, p, d + timedelta(days=n)) for n in range(length)]
            expected.append((b, p, d, run[-1][2], length, sum(refused.get(key, 0) for key in run)))
    found = availability.stockout_periods(
        availability.stockout_days(f["snapshots"], f["cancellations"], f["branches"], f["products"])
    ).select("branch_id", "product_id", "stockout_start", "stockout_end", "stockout_days", "cancelled_quantity")
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_phantom(data):
    raw, f = data
    shown = [r for r in raw["cancellations"] if r[5] == "SYSTEM_SHOWED_AVAILABLE"]
    refused = daily(shown, 3, lambda r: r[4])
    expected = [
        (b, p, d, s, refused[b, p, d], round(refused[b, p, d] * 2.15, 2))
        for _, b, p, d, s in raw["snapshots"]
        if s > 0 and (b, p, d) in refused
    ]
    found = availability.phantom_inventory(f["snapshots"], f["cancellations"], f["branches"], f["products"])
    picked = found.selectExpr(
        "branch_id", "product_id", "snapshot_date", "recorded_closing_stock", "cancelled_quantity",
        "CAST(directly_observed_lost_revenue AS DOUBLE) AS lost",
    )
    assert sorted(map(tuple, picked.collect())) == sorted(expected)


def test_suppliers(data):
    raw, f = data
    placed = defaultdict(list)
    for row in raw["supplier_orders"]:
        placed[row[3]].append(row)
    suppliers = f["products"].sparkSession.createDataFrame([(n, f"S{n}") for n in range(1, 6)], "supplier_id bigint, supplier_name string")
    found = performance.supplier_performance(f["supplier_orders"], suppliers)
    for row in found.collect():
        mine = placed.pop(row.supplier_id)
        late = sum(r[6] > r[5] for r in mine)
        assert (row.total_orders, row.late_orders) == (len(mine), late)
        assert row.on_time_delivery_rate == pytest.approx(100 * (len(mine) - late) / len(mine), abs=0.0051)
        assert row.fill_rate == pytest.approx(100 * sum(r[8] for r in mine) / sum(r[7] for r in mine), abs=0.0051)
        assert row.average_delay_days == pytest.approx(sum((r[6] - r[5]).days for r in mine) / len(mine), abs=0.0051)
    assert not placed


def test_missing_deliveries_with_a_hot_reference(data):
    raw, f = data
    booked = {r[6] for r in raw["movements"] if r[4] == "DELIVERY" and r[6]}
    expected = [(r[0],) for r in raw["supplier_orders"] if f"SUP-{r[0]}" not in booked]
    found = integrity.orders_without_movement(f["supplier_orders"], f["movements"])
    assert sorted(map(tuple, found.select("supplier_order_id").collect())) == expected


def test_recall_with_a_hot_label(spark):
    known = table(spark, "known_issues", [("A", 1, 1, START)] * 200 + [("A", 1, n, START) for n in range(2, 402)])
    detected = spark.createDataFrame([("A", 1, n, START) for n in range(1, 102)], known.schema)
    assert rows(reports.recall(known, detected)) == [("A", 600, 300, 50.0)]
