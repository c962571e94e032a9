"""Tables in which every rule of the model is broken by some rows, for checking the rules.

Values are replaced by conditions on the table's key, then some rows are repeated. The
conditions are plain SQL that both engines run on the derived tables.
"""

from collections.abc import Mapping

from pyspark.sql import DataFrame

#: table -> column -> value.
CHANGES = {
    "branches": {"region": "CASE WHEN branch_id % 4 = 1 THEN NULL ELSE region END"},
    "suppliers": {"supplier_name": "CASE WHEN supplier_id % 40 = 3 THEN NULL ELSE supplier_name END"},
    "products": {
        "selling_price": "CASE WHEN product_id % 5 = 2 THEN unit_cost - 1 ELSE selling_price END",
        "target_stock": "CASE WHEN product_id % 7 = 3 THEN reorder_point - 1 ELSE target_stock END",
        "reorder_point": "CASE WHEN product_id % 11 = 4 THEN -1 ELSE reorder_point END",
        "unit_cost": "CASE WHEN product_id % 13 = 5 THEN -unit_cost ELSE unit_cost END",
        "category": "CASE WHEN product_id % 6 = 1 THEN NULL ELSE category END",
        "supplier_id": "CASE WHEN product_id % 9 = 1 THEN -supplier_id ELSE supplier_id END",
    },
    "sales": {
        "quantity": "CASE WHEN sale_id % 101 = 3 THEN -quantity ELSE quantity END",
        "revenue": "CASE WHEN sale_id % 103 = 5 THEN NULL WHEN sale_id % 107 = 6 THEN -revenue ELSE revenue END",
        "product_id": "CASE WHEN sale_id % 109 = 1 THEN -product_id ELSE product_id END",
        "branch_id": "CASE WHEN sale_id % 113 = 1 THEN NULL WHEN sale_id % 109 = 1 THEN -7 ELSE branch_id END",
    },
    "supplier_orders": {
        "received_quantity": "CASE WHEN supplier_order_id % 53 = 4 THEN 0 ELSE received_quantity END",
        "ordered_quantity": "CASE WHEN supplier_order_id % 59 = 4 THEN NULL ELSE ordered_quantity END",
        "order_date": "CASE WHEN supplier_order_id % 61 = 2 THEN NULL ELSE order_date END",
        "supplier_id": "CASE WHEN supplier_order_id % 67 = 1 THEN 0 ELSE supplier_id END",
    },
    "movements": {
        "movement_type": "CASE WHEN movement_id % 101 = 2 THEN 'BOGUS' WHEN movement_id % 103 = 2 THEN NULL ELSE movement_type END",
        "quantity": "CASE WHEN movement_id % 107 = 2 THEN 0 ELSE quantity END",
        "product_id": "CASE WHEN movement_id % 109 = 2 THEN -1 ELSE product_id END",
    },
    "snapshots": {
        "recorded_closing_stock": "CASE WHEN snapshot_id % 997 = 1 THEN NULL ELSE recorded_closing_stock END",
        "branch_id": "CASE WHEN snapshot_id % 991 = 1 THEN 0 ELSE branch_id END",
    },
    "cancellations": {
        "reason": "CASE WHEN cancellation_id % 17 = 2 THEN 'OTHER' ELSE reason END",
        "requested_quantity": "CASE WHEN cancellation_id % 19 = 2 THEN 0 ELSE requested_quantity END",
        "product_id": "CASE WHEN cancellation_id % 23 = 2 THEN -product_id ELSE product_id END",
    },
}

#: table -> rows that occur twice.
REPEATED = {
    "branches": "branch_id % 5 = 2",
    "suppliers": "supplier_id % 50 = 7",
    "products": "product_id % 10 = 3",
    "sales": "sale_id % 499 = 9",
    "supplier_orders": "supplier_order_id % 97 = 9",
    "movements": "movement_id % 499 = 9",
    "snapshots": "snapshot_id % 2999 = 9",
    "cancellations": "cancellation_id % 29 = 9",
}


def broken_tables(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    found = {}
    for name, again in REPEATED.items():
        changes, whole = CHANGES[name], tables[name]
        kinds = dict(whole.dtypes)
        columns = [f"CAST({changes[c]} AS {kinds[c]}) AS {c}" if c in changes else c for c in whole.columns]
        changed = whole.selectExpr(*columns)
        found[name] = changed.unionByName(changed.where(again))
    return found


def broken_sql() -> str:
    """The same tables as common table expressions ``broken_<table>``."""
    parts = []
    for name, again in REPEATED.items():
        changes = ", ".join(f"{value} AS {column}" for column, value in CHANGES[name].items())
        parts.append(f"changed_{name} AS (SELECT * REPLACE ({changes}) FROM {name})")
        parts.append(f"broken_{name} AS (FROM changed_{name} UNION ALL FROM changed_{name} WHERE {again})")
    return ", ".join(parts)
