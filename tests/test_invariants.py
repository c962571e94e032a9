"""Relations between the views that hold on any data."""

from pyspark.sql import functions as F


def total(df, column):
    return df.agg(F.sum(column)).collect()[0][0]


def test_counts_agree(inventory, all_views):
    v = all_views
    assert v["inventory_reconciliation"].count() == inventory["snapshots"].count()
    assert v["reconciliation_issues"].count() == total(v["branch_inventory_health"], "issue_count") > 0
    assert total(v["stockout_periods"], "stockout_days") == v["stockout_days"].count() > 0
    assert v["lost_sales_estimate"].count() == v["stockout_days"].count()
    assert v["phantom_inventory"].count() == total(v["branch_inventory_health"], "phantom_incidents") > 0
    listed = v["data_quality_issues"].where("issue_type = 'Duplicate inventory movement'").count()
    assert listed == v["duplicate_movements"].count() > 0
    assert total(v["supplier_performance"], "total_orders") == inventory["supplier_orders"].count()


def test_on_time_and_late_make_all_orders(all_views):
    rate = "round(100D * (total_orders - late_orders) / total_orders, 2)"
    assert all_views["supplier_performance"].where(f"on_time_delivery_rate <> {rate}").isEmpty()


def test_lost_units_at_least_cancelled(all_views):
    assert all_views["lost_sales_estimate"].where("estimated_lost_units < cancelled_quantity").isEmpty()


def test_status_follows_difference(all_views):
    recon = all_views["inventory_reconciliation"]
    assert recon.where("(stock_difference = 0) <> (reconciliation_status = 'Reconciled')").isEmpty()
    assert recon.where("net_movement <> inflow_quantity - outflow_quantity").isEmpty()
