"""Loads of new days: what earlier days still matter for is carried as a small state.

A load takes the facts of the days after the last load, up to and including ``until``, and adds
their rows to the views. Earlier results and facts are not read. Carried are

* ``last_stock``, the last snapshot of each series, which the next one is compared with;
* ``open_runs``, stockout periods that reach the last loaded day and may go on;
* ``recent_sales``, daily sales that a later day may look back at;
* ``branch_parts``, sums per branch and load, from which branch health is put together.

All of a load becomes visible at once (``sources.refresh``); a load that breaks off changes
nothing and is simply run again. Facts of a loaded day must be complete: rows that arrive for it
later are not taken up. Supplier orders count on the day of their delivery. Facts without a day
belong to no load; the integrity rules list them.
"""

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockrecon.operators import availability, copies, demand, ledger, performance, reconcile
from stockrecon.operators.series import SERIES
from stockrecon.session import new_folder
from stockrecon.sources import refresh
from stockrecon.sources.tables import load_tables

# The column that says to which day a fact belongs.
DAYS = {
    "sales": "sale_time",
    "movements": "movement_time",
    "snapshots": "snapshot_date",
    "cancellations": "cancellation_time",
    "supplier_orders": "actual_delivery_date",
}
#: Views whose rows belong to one day; each load adds its own.
DAILY = (
    "daily_sales",
    "daily_movements",
    "inventory_reconciliation",
    "reconciliation_issues",
    "phantom_inventory",
    "stockout_days",
    "lost_sales_estimate",
)


def _from(column: str, day: date) -> Column:
    """On or after the start of a day; times and days alike, so that it reaches the scan."""
    return F.col(column) >= F.lit(day.isoformat()).cast("date" if column.endswith("_date") else "timestamp_ntz")


def days_between(t: Mapping[str, DataFrame], after: date | None, until: date) -> dict[str, DataFrame]:
    """The tables with only the facts after one day and up to another."""
    new = dict(t)
    for name, column in DAYS.items():
        rows = t[name].where(F.col(column).isNotNull() & ~_from(column, until + timedelta(days=1)))
        new[name] = rows if after is None else rows.where(_from(column, after + timedelta(days=1)))
    return new


def loaded_until(spark: SparkSession, target: str) -> date | None:
    """The last loaded day; None before the first load."""
    noted = refresh.note(spark, target)
    return date.fromisoformat(noted) if noted else None


def advance(spark: SparkSession, t: Mapping[str, DataFrame], target: str, until: date) -> int:
    """Load the days after the last load up to ``until``; returns the new version."""
    after = loaded_until(spark, target)
    if after is not None and until <= after:
        raise ValueError(f"loaded until {after}, can't go on to {until}")
    state = refresh.current(spark, target)
    new = days_between(t, after, until)
    dims = (t["branches"], t["products"])
    load = refresh.Load(spark, target)

    sales = load.write("daily_sales", ledger.daily_sales(new["sales"]))
    moved = load.write("daily_movements", ledger.daily_movements(new["movements"]))
    last = state.get("last_stock")
    recon = load.write(
        "inventory_reconciliation", reconcile.inventory_reconciliation(new["snapshots"], *dims, moved, last)
    )
    load.write("last_stock", reconcile.last_stock(new["snapshots"], last))
    surplus = copies.duplicate_days(new["movements"])
    load.write("reconciliation_issues", reconcile.reconciliation_issues(recon, surplus, new["supplier_orders"]))
    touched = availability.touched(new["snapshots"], new["cancellations"])
    touched = load_tables({"touched": touched}, new_folder(spark, "load"))["touched"]
    phantom = load.write("phantom_inventory", availability.phantom_inventory(touched, new["cancellations"], *dims))
    days = load.write("stockout_days", availability.stockout_days(touched, new["cancellations"], *dims))
    runs = load.write("runs", availability.continued_periods(days, state.get("open_runs")))
    open_ = F.col("stockout_end") == F.lit(until)
    load.write("stockout_periods", runs.where(~open_))
    load.write("open_runs", runs.where(open_))
    recent = sales.select(*SERIES, "sale_date", "units_sold")
    if "recent_sales" in state:
        recent = recent.unionByName(state["recent_sales"])
    lost = load.write("lost_sales_estimate", demand.lost_sales_estimate(days, recent, t["products"]))
    oldest = until - timedelta(days=max(demand.lookback_days()))
    load.write("recent_sales", recent.where(F.col("sale_date") > F.lit(oldest)))
    load.write("branch_parts", performance.branch_sums(recon, phantom, lost))
    return load.commit(until.isoformat(), {*DAILY, "stockout_periods", "branch_parts"})


def views(spark: SparkSession, t: Mapping[str, DataFrame], target: str) -> dict[str, DataFrame]:
    """The views over all loaded days."""
    stored = refresh.current(spark, target)
    return {
        **{name: stored[name] for name in DAILY},
        "stockout_periods": stored["stockout_periods"].unionByName(stored["open_runs"]),
        "branch_inventory_health": performance.health_of_sums(t["branches"], stored["branch_parts"]),
    }
