"""Recorded stock against the movement ledger, and the likely cause of each difference."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockrecon.functions import expressions as X
from stockrecon.operators.ledger import delivery_days
from stockrecon.operators.series import SERIES, by_series, left_join_zero, with_dims
from stockrecon.schemas import RESULTS

_LEDGER_MEASURES = ["inflow_quantity", "outflow_quantity", "net_movement"]


def previous_stock(snapshots: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """Add the recorded stock of the previous snapshot of the series, whatever its date.

    A series has one snapshot per day, so a window holds no more rows than there are days.
    ``carried`` may hold the ``last_stock`` before these snapshots, one row per series. It is joined
    to the first new snapshot of its series, so stored snapshots keep their layout; rows without
    a branch or product, which no result keeps, find none.
    """
    earlier = Window.partitionBy(*SERIES).orderBy("snapshot_date")
    before = F.lag("recorded_closing_stock").over(earlier)
    if carried is None:
        return snapshots.withColumn("previous_recorded_stock", before)
    numbered = snapshots.withColumns({"previous_recorded_stock": before, "_number": F.row_number().over(earlier)})
    last = carried.select(*SERIES, F.col("recorded_closing_stock").alias("_carried"))
    first = F.when(F.col("_number") == 1, F.col("_carried")).otherwise(F.col("previous_recorded_stock"))
    return (
        numbered.join(last, SERIES, "left")
        .withColumn("previous_recorded_stock", first)
        .select(*snapshots.columns, "previous_recorded_stock")
    )


def last_stock(snapshots: DataFrame, carried: DataFrame | None = None) -> DataFrame:
    """Day and stock of the last snapshot of each series, with partial maxima."""
    rows = snapshots.select(*SERIES, "snapshot_date", "recorded_closing_stock")
    rows = rows if carried is None else rows.unionByName(carried)
    last = F.max(F.struct("snapshot_date", "recorded_closing_stock")).alias("last")
    return rows.groupBy(*SERIES).agg(last).select(*SERIES, "last.*")


def inventory_reconciliation(
    snapshots: DataFrame,
    branches: DataFrame,
    products: DataFrame,
    daily_movements: DataFrame,
    carried: DataFrame | None = None,
) -> DataFrame:
    """One row per snapshot: expected stock, difference and status.

    Expected stock is the previously *recorded* stock plus the day's net movement, so an
    error shows on the day it happens and is not carried on. Names are joined last, so that
    a filter on the difference runs before them. ``carried`` is the last stock before these days.
    """
    ledger = by_series(daily_movements, "movement_date", "snapshot_date")
    compared = (
        left_join_zero(previous_stock(snapshots, carried), ledger, "snapshot_date", _LEDGER_MEASURES)
        .withColumn(
            "expected_closing_stock", X.expected_stock(F.col("previous_recorded_stock"), F.col("net_movement"))
        )
        .withColumn("stock_difference", F.col("recorded_closing_stock") - F.col("expected_closing_stock"))
        .withColumn(
            "reconciliation_status",
            X.reconciliation_status(F.col("recorded_closing_stock"), F.col("expected_closing_stock")),
        )
    )
    return with_dims(compared, branches, products).select(*RESULTS["inventory_reconciliation"].names)


def reconciliation_issues(recon: DataFrame, surplus: DataFrame, orders: DataFrame) -> DataFrame:
    """Snapshots that differ from the ledger, with severity and probable cause.

    ``surplus`` holds the surplus copies per day, as from ``copies.duplicate_days``.
    """
    differing = recon.where(F.col("stock_difference") != 0)
    surplus = by_series(surplus, "issue_date", "snapshot_date")
    deliveries = by_series(delivery_days(orders), "issue_date", "snapshot_date")
    explained = left_join_zero(differing, surplus, "snapshot_date", ["duplicate_count"])
    explained = left_join_zero(explained, deliveries, "snapshot_date", ["delivery_count"])
    difference = F.col("stock_difference")
    return explained.select(
        *recon.columns,
        F.col("duplicate_count").alias("duplicate_movement_count"),
        X.issue_severity(difference).alias("issue_severity"),
        X.probable_issue(
            difference, F.col("duplicate_count"), F.col("delivery_count"), F.col("inflow_quantity")
        ).alias("probable_issue"),
    )
