import pytest
from frames import at, branches, day, money, movements, orders, products, rows, snapshots, table

from stockrecon.operators import copies, integrity
from stockrecon.schemas import TABLES


def clean(spark):
    return {
        "branches": branches(spark, 1),
        "suppliers": table(spark, "suppliers", [(1, "One")]),
        "products": products(spark),
        "sales": table(spark, "sales", [(1, 1, 1, at("2025-01-01 09:00:00"), 1, money("2.00"))]),
        "supplier_orders": orders(spark, (1, 1, 1, 1, "2025-01-01", "2025-01-02", 5, 5)),
        "movements": movements(spark, (1, 1, "2025-01-02 07:00:00", "DELIVERY", 5, "SUP-1")),
        "snapshots": snapshots(spark, (1, 1, "2025-01-01", 0)),
        "cancellations": table(spark, "cancellations", [(1, 1, 1, at("2025-01-01 09:00:00"), 1, "OUT_OF_STOCK")]),
    }


def broken(spark, name, bad_rows, *families):
    tables = clean(spark)
    tables[name] = tables[name].unionByName(table(spark, name, bad_rows))
    return rows(integrity.violations(tables, *families), "rule_id", "table_name", "record_id", "detail")


def test_clean_tables_pass(spark):
    assert rows(integrity.violations(clean(spark))) == []
    integrity.assert_integrity(clean(spark))


def test_primary_key(spark):
    found = broken(spark, "branches", [(1, "B", "N"), (None, "C", "N")], "Q1")
    assert found == [
        ("Q1", "branches", "1", "branch_id: 2 rows"),
        ("Q1", "branches", "NULL", "branch_id: 1 rows"),
    ]


def test_unique(spark):
    assert broken(spark, "branches", [(2, "Branch 1", "N"), (3, None, "N"), (4, None, "N")], "Q2") == [
        ("Q2", "branches", "Branch 1", "branch_name: 2 rows")
    ]
    again = [(2, 1, 1, day("2025-01-01"), 4)]
    assert broken(spark, "snapshots", again, "Q2") == [
        ("Q2", "snapshots", "1, 1, 2025-01-01", "branch_id, product_id, snapshot_date: 2 rows")
    ]


def test_not_null_spares_reference(spark):
    assert broken(spark, "movements", [(2, 1, 1, None, "SALE", None, None)], "Q3") == [
        ("Q3", "movements", "2", "movement_time is null"),
        ("Q3", "movements", "2", "quantity is null"),
    ]


def test_enum_passes_on_null(spark):
    bad = [(2, 1, 1, None, "STOLEN", 1, None), (3, 1, 1, None, None, 1, None)]
    found = broken(spark, "movements", bad, "Q4")
    assert [row[:3] for row in found] == [("Q4", "movements", "2")]
    refused = [(2, 1, 1, None, 1, "BORED"), (3, 1, 1, None, 1, None)]
    assert broken(spark, "cancellations", refused, "Q4") == [
        ("Q4", "cancellations", "2", "reason IN ('OUT_OF_STOCK', 'SYSTEM_SHOWED_AVAILABLE')")
    ]


@pytest.mark.parametrize(
    "name, bad, detail",
    [
        ("sales", (2, 1, 1, None, 0, money("1.00")), "quantity > 0"),
        ("sales", (2, 1, 1, None, 1, money("-0.01")), "revenue >= 0"),
        ("supplier_orders", (2, 1, 1, 1, None, None, None, 0, 1), "ordered_quantity > 0"),
        ("supplier_orders", (2, 1, 1, 1, None, None, None, 1, -1), "received_quantity > 0"),
        ("movements", (2, 1, 1, None, "SALE", 0, None), "quantity > 0"),
        ("cancellations", (2, 1, 1, None, 0, "OUT_OF_STOCK"), "requested_quantity > 0"),
        ("products", (3, "s", "n", "c", 1, money("-1.00"), money("2.00"), 1, 2), "unit_cost >= 0"),
        ("products", (3, "s", "n", "c", 1, money("1.00"), money("2.00"), -1, 2), "reorder_point >= 0"),
    ],
)
def test_range(spark, name, bad, detail):
    key = str(bad[0])
    unset = [None if column in detail else value for column, value in zip(TABLES[name].names, bad)]
    unset[0] = 99
    assert broken(spark, name, [bad, tuple(unset)], "Q5") == [("Q5", name, key, detail)]


def test_cross_column(spark):
    bad = [
        (3, "s", "n", "c", 1, money("2.00"), money("1.99"), 5, 4),
        (4, "t", "n", "c", 1, None, money("1.99"), 5, None),
    ]
    assert broken(spark, "products", bad, "Q6") == [
        ("Q6", "products", "3", "selling_price >= unit_cost"),
        ("Q6", "products", "3", "target_stock >= reorder_point"),
    ]


def test_foreign_keys_ignore_null(spark):
    bad = [(2, 9, 1, 8, None, None, None, 1, 1), (3, None, 1, None, None, None, None, 1, 1)]
    assert broken(spark, "supplier_orders", bad, "Q7") == [
        ("Q7", "supplier_orders", "2", "branch_id 9 not in branches"),
        ("Q7", "supplier_orders", "2", "supplier_id 8 not in suppliers"),
    ]


def test_assert_integrity_raises_first_ten(spark):
    tables = clean(spark)
    tables["sales"] = table(spark, "sales", [(n, 7, 1, None, 1, None) for n in range(25)])
    with pytest.raises(integrity.IntegrityError) as error:
        integrity.assert_integrity(tables, 10, "Q7")
    assert len(error.value.args[0]) == 10
    assert {row[3] for row in error.value.args[0]} == {"branch_id 7 not in branches"}


def test_orders_without_movement(spark):
    placed = orders(spark, *[(n, 1, 1, 1, "2025-01-01", "2025-01-02", 5, 5) for n in (1, 2, 3)])
    moved = movements(
        spark,
        (1, 1, "2025-01-02 07:00:00", "DELIVERY", 5, "SUP-1"),
        (1, 1, "2025-01-02 07:00:00", "DELIVERY", 5, "SUP-1"),
        (1, 1, "2025-01-02 07:00:00", "POSITIVE_ADJUSTMENT", 5, "SUP-2"),
        (2, 2, "2025-03-02 07:00:00", "DELIVERY", 1, "SUP-3"),
        (1, 1, "2025-01-02 07:00:00", "DELIVERY", 5, None),
    )
    unbooked = integrity.orders_without_movement(placed, moved)
    assert rows(unbooked, "supplier_order_id") == [(2,)]
    assert rows(integrity.data_quality_issues(copies.duplicate_movements(moved), unbooked)) == [
        ("Delivered supplier order without movement", 2, 1, 1, day("2025-01-02")),
        ("Duplicate inventory movement", 2, 1, 1, day("2025-01-02")),
    ]
