"""Schemas of the input tables and of the results.

Money is DECIMAL(18,2): sums do not depend on the order of rows, and a half cent
rounds up on every engine.
"""

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
UNITS = T.DecimalType(18, 2)

_LONG, _TEXT, _DATE, _TIME, _DOUBLE = (
    T.LongType(),
    T.StringType(),
    T.DateType(),
    T.TimestampNTZType(),
    T.DoubleType(),
)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


# Names and order of the columns of tables and results.
TABLES: dict[str, T.StructType] = {
    "branches": _struct(branch_id=_LONG, branch_name=_TEXT, region=_TEXT),
    "suppliers": _struct(supplier_id=_LONG, supplier_name=_TEXT),
    "products": _struct(
        product_id=_LONG,
        sku=_TEXT,
        product_name=_TEXT,
        category=_TEXT,
        supplier_id=_LONG,
        unit_cost=MONEY,
        selling_price=MONEY,
        reorder_point=_LONG,
        target_stock=_LONG,
    ),
    "sales": _struct(
        sale_id=_LONG,
        branch_id=_LONG,
        product_id=_LONG,
        sale_time=_TIME,
        quantity=_LONG,
        revenue=MONEY,
    ),
    "supplier_orders": _struct(
        supplier_order_id=_LONG,
        branch_id=_LONG,
        product_id=_LONG,
        supplier_id=_LONG,
        order_date=_DATE,
        expected_delivery_date=_DATE,
        actual_delivery_date=_DATE,
        ordered_quantity=_LONG,
        received_quantity=_LONG,
    ),
    "movements": _struct(
        movement_id=_LONG,
        branch_id=_LONG,
        product_id=_LONG,
        movement_time=_TIME,
        movement_type=_TEXT,
        quantity=_LONG,
        reference_id=_TEXT,
    ),
    "snapshots": _struct(
        snapshot_id=_LONG,
        branch_id=_LONG,
        product_id=_LONG,
        snapshot_date=_DATE,
        recorded_closing_stock=_LONG,
    ),
    "cancellations": _struct(
        cancellation_id=_LONG,
        branch_id=_LONG,
        product_id=_LONG,
        cancellation_time=_TIME,
        requested_quantity=_LONG,
        reason=_TEXT,
    ),
}

KNOWN_ISSUES = _struct(issue_type=_TEXT, branch_id=_LONG, product_id=_LONG, issue_date=_DATE)

_ITEM = dict(branch_id=_LONG, branch_name=_TEXT, product_id=_LONG, sku=_TEXT, product_name=_TEXT, category=_TEXT)
_RECONCILIATION = dict(
    snapshot_id=_LONG,
    **_ITEM,
    snapshot_date=_DATE,
    recorded_closing_stock=_LONG,
    previous_recorded_stock=_LONG,
    inflow_quantity=_LONG,
    outflow_quantity=_LONG,
    net_movement=_LONG,
    expected_closing_stock=_LONG,
    stock_difference=_LONG,
    reconciliation_status=_TEXT,
)
_STOCKOUT_DAY = dict(**_ITEM, stockout_date=_DATE, recorded_closing_stock=_LONG, cancelled_quantity=_LONG)

RESULTS: dict[str, T.StructType] = {
    "inventory_reconciliation": _struct(**_RECONCILIATION),
    "reconciliation_issues": _struct(
        **_RECONCILIATION, duplicate_movement_count=_LONG, issue_severity=_TEXT, probable_issue=_TEXT
    ),
    "phantom_inventory": _struct(
        **_ITEM,
        snapshot_date=_DATE,
        recorded_closing_stock=_LONG,
        cancelled_quantity=_LONG,
        directly_observed_lost_revenue=MONEY,
    ),
    "stockout_days": _struct(**_STOCKOUT_DAY),
    "stockout_periods": _struct(
        **_ITEM, stockout_start=_DATE, stockout_end=_DATE, stockout_days=_LONG, cancelled_quantity=_LONG
    ),
    "lost_sales_estimate": _struct(
        **_STOCKOUT_DAY,
        actual_units_sold=_LONG,
        expected_units=UNITS,
        estimated_lost_units=UNITS,
        estimated_lost_revenue=MONEY,
        estimated_lost_gross_profit=MONEY,
    ),
    "supplier_performance": _struct(
        supplier_id=_LONG,
        supplier_name=_TEXT,
        total_orders=_LONG,
        late_orders=_LONG,
        on_time_delivery_rate=_DOUBLE,
        fill_rate=_DOUBLE,
        average_delay_days=_DOUBLE,
    ),
    "branch_inventory_health": _struct(
        branch_id=_LONG,
        branch_name=_TEXT,
        region=_TEXT,
        snapshots=_LONG,
        issue_count=_LONG,
        reconciliation_issue_rate=_DOUBLE,
        absolute_stock_difference=_LONG,
        phantom_incidents=_LONG,
        estimated_lost_revenue=T.DecimalType(28, 2),
        estimated_lost_gross_profit=T.DecimalType(28, 2),
        risk_rank=_LONG,
    ),
    "data_quality_issues": _struct(
        issue_type=_TEXT, record_id=_LONG, branch_id=_LONG, product_id=_LONG, issue_date=_DATE
    ),
    "validation_summary": _struct(
        issue_type=_TEXT, expected_issues=_LONG, detected_issues=_LONG, detection_rate=_DOUBLE
    ),
}
