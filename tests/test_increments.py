"""Loads of new days give what one load of all days gives."""

from datetime import timedelta

import pytest
from frames import branches, cancellations, day, movements, products, rows, sales, snapshots, table
from pyspark.sql import functions as F

from stockrecon.plans import analysis, increments
from stockrecon.session import new_folder
from stockrecon.sources import refresh
from test_plans import plan


def same(found, expected):
    kinds = {field.name: field.dataType for field in expected.schema}
    found = found.select(*[F.col(name).cast(kind) for name, kind in kinds.items()])
    return sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_three_loads_equal_one(spark, inventory, all_views):
    first, last = inventory["snapshots"].agg(F.min("snapshot_date"), F.max("snapshot_date")).first()
    last = max([last, *(inventory[n].agg(F.max(F.col(c).cast("date"))).first()[0] for n, c in increments.DAYS.items())])
    target = new_folder(spark, "loads")
    length = (last - first).days
    for until in (first + timedelta(days=length // 3), first + timedelta(days=length // 2), last):
        increments.advance(spark, inventory, target, until)
        assert increments.loaded_until(spark, target) == until
    found = increments.views(spark, inventory, target)
    for name, df in found.items():
        assert same(df, all_views[name]), name
    counted = {r["name"]: r["rows"] for r in refresh.row_counts(spark, target).collect()}
    assert counted["stockout_days"] == all_views["stockout_days"].count() > 0


def small(spark):
    """Two series over some days: a gap between snapshots, a run across loads, sales to look back at."""
    stock = [(1, 1, "2025-01-01", 5), (1, 1, "2025-01-06", 0), (1, 1, "2025-01-07", 0), (1, 1, "2025-01-08", 0),
             (1, 1, "2025-01-09", 3), (1, 2, "2025-01-02", 4), (1, 2, "2025-01-29", 0), (1, 2, "2025-01-31", 0)]
    return {
        "branches": branches(spark, 1, 2),
        "products": products(spark),
        "snapshots": snapshots(spark, *stock),
        "sales": sales(spark, (1, 2, "2025-01-01 10:00:00", 8, "9.00"), (1, 2, "2025-01-22 23:59:59", 4, "9.00")),
        "movements": movements(spark, (1, 1, "2025-01-06 00:00:00", "SALE", 5, None), (1, 1, "2025-01-09 12:00:00", "DELIVERY", 2, "x")),
        "cancellations": cancellations(spark, (1, 1, "2025-01-07 23:59:59", 2, "SYSTEM_SHOWED_AVAILABLE")),
        "supplier_orders": table(spark, "supplier_orders", []),
        "suppliers": table(spark, "suppliers", []),
    }


def test_state_is_carried_over_quiet_loads(spark):
    t = small(spark)
    target = new_folder(spark, "loads")
    until = day("2025-01-01")
    while until < day("2025-01-31"):
        until = min(until + timedelta(days=12), day("2025-01-31"))
        increments.advance(spark, t, target, until)
    found = increments.views(spark, t, target)
    full = analysis.views(t)
    for name, df in found.items():
        assert same(df, full[name]), name
    assert rows(found["stockout_periods"], "stockout_start", "stockout_days", "cancelled_quantity") == [
        (day("2025-01-06"), 3, 2), (day("2025-01-29"), 1, 0), (day("2025-01-31"), 1, 0)]


def test_a_load_that_breaks_off_changes_nothing(spark):
    t = small(spark)
    target = new_folder(spark, "loads")
    increments.advance(spark, t, target, day("2025-01-07"))
    before = {name: sorted(map(str, df.collect())) for name, df in increments.views(spark, t, target).items()}
    broken = F.when(F.col("unit_cost").isNotNull(), F.raise_error(F.lit("no prices")).cast("decimal(18,2)"))
    with pytest.raises(Exception, match="no prices"):
        increments.advance(spark, t | {"products": t["products"].withColumn("unit_cost", broken)}, target, day("2025-01-31"))
    assert increments.loaded_until(spark, target) == day("2025-01-07")
    assert before == {name: sorted(map(str, df.collect())) for name, df in increments.views(spark, t, target).items()}
    increments.advance(spark, t, target, day("2025-01-31"))
    full = analysis.views(t)
    assert all(same(df, full[name]) for name, df in increments.views(spark, t, target).items())


def test_days_are_loaded_once(spark):
    t = small(spark)
    target = new_folder(spark, "loads")
    increments.advance(spark, t, target, day("2025-01-07"))
    with pytest.raises(ValueError, match="loaded until 2025-01-07"):
        increments.advance(spark, t, target, day("2025-01-07"))


def test_only_new_days_are_read(spark, inventory):
    """Range filters on the day reach the scan of each fact table; nothing else of it is read."""
    # The plan shows filters up to a length that must be set before the plan is made.
    key = "spark.sql.maxMetadataStringLength"
    spark.conf.set(key, "1000")
    try:
        new = increments.days_between(inventory, day("2024-01-10"), day("2024-01-11"))
        texts = {name: plan(new[name]) for name in increments.DAYS}
    finally:
        spark.conf.unset(key)
    for name, column in increments.DAYS.items():
        assert f"GreaterThanOrEqual({column},2024-01-11" in texts[name], texts[name]
        assert f"LessThan({column},2024-01-12" in texts[name], texts[name]
