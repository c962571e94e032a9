"""Stock that is shown but cannot be sold, and days without stock."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockrecon import labels as L
from stockrecon.functions import expressions as X
from stockrecon.operators.ledger import cancelled_by_day
from stockrecon.operators.series import SERIES, by_series, join_bpd, left_join_zero, with_dims
from stockrecon.schemas import MONEY, RESULTS, UNITS


def touched(snapshots: DataFrame, cancellations: DataFrame) -> DataFrame:
    """Snapshots without stock or with a cancelled sale on their day.

    ``phantom_inventory`` and ``stockout_days`` keep none but these. Stored, they are found in one pass
    over the snapshots instead of two.
    """
    cancelled = by_series(cancelled_by_day(cancellations), "cancellation_date", "snapshot_date")
    days = cancelled.select(*SERIES, "snapshot_date", F.lit(True).alias("_cancelled"))
    found = (F.col("recorded_closing_stock") == 0) | F.col("_cancelled")
    return join_bpd(snapshots, days, "snapshot_date", "left").where(found).select(*snapshots.columns)


def phantom_inventory(
    snapshots: DataFrame, cancellations: DataFrame, branches: DataFrame, products: DataFrame
) -> DataFrame:
    """Days on which sales were cancelled for lack of goods although stock was on record."""
    cancelled = cancelled_by_day(cancellations, L.SYSTEM_SHOWED_AVAILABLE)
    refused = by_series(cancelled, "cancellation_date", "snapshot_date")
    shown = snapshots.where(F.col("recorded_closing_stock") > 0)
    cases = with_dims(join_bpd(shown, refused, "snapshot_date"), branches, products, "selling_price")
    value = X.round2(F.col("cancelled_quantity").cast(UNITS) * F.col("selling_price")).cast(MONEY)
    return cases.withColumn("directly_observed_lost_revenue", value).select(*RESULTS["phantom_inventory"].names)


def stockout_days(
    snapshots: DataFrame, cancellations: DataFrame, branches: DataFrame, products: DataFrame
) -> DataFrame:
    """Days with no recorded stock, or with any cancelled sale whatever the stock."""
    cancelled = by_series(cancelled_by_day(cancellations), "cancellation_date", "snapshot_date")
    days = left_join_zero(snapshots, cancelled, "snapshot_date", ["cancelled_quantity"]).where(
        (F.col("recorded_closing_stock") == 0) | (F.col("cancelled_quantity") > 0)
    )
    return with_dims(days.withColumnRenamed("snapshot_date", "stockout_date"), branches, products).select(
        *RESULTS["stockout_days"].names
    )


def number_days(days: DataFrame) -> DataFrame:
    """Count the stockout days of each series in order of date."""
    in_order = Window.partitionBy(*SERIES).orderBy("stockout_date")
    return days.withColumn("row_number", F.row_number().over(in_order).cast("bigint"))


def stockout_periods(days: DataFrame) -> DataFrame:
    """Runs of consecutive stockout days.

    Date minus position is the same for all days of a run. The grouping reuses the layout
    of the window, so it adds no shuffle.
    """
    island = X.island_id(F.col("stockout_date"), F.col("row_number"))
    names = ["branch_id", "branch_name", "product_id", "sku", "product_name", "category"]
    return (
        number_days(days)
        .groupBy(*names, island.alias("island"))
        .agg(
            F.min("stockout_date").alias("stockout_start"),
            F.max("stockout_date").alias("stockout_end"),
            F.count(F.lit(1)).alias("stockout_days"),
            F.sum("cancelled_quantity").alias("cancelled_quantity"),
        )
        .drop("island")
    )


def continued_periods(days: DataFrame, open_runs: DataFrame | None = None) -> DataFrame:
    """Runs of consecutive stockout days that may carry on a run of earlier days.

    ``open_runs`` are periods that end before ``days`` begin, at most one per series. One of them
    joins the run of the day after its end; if there is none, it stands as it is.
    """
    found = stockout_periods(days)
    if open_runs is None:
        return found
    names = [name for name in found.columns if not name.startswith("stockout_") and name != "cancelled_quantity"]
    series = Window.partitionBy(*SERIES).orderBy("stockout_start")
    follows = F.datediff("stockout_start", F.lag("stockout_end").over(series)) == 1
    rows = found.unionByName(open_runs).withColumn("begins", (~F.coalesce(follows, F.lit(False))).cast("int"))
    numbered = rows.withColumn("run", F.sum("begins").over(series.rowsBetween(Window.unboundedPreceding, 0)))
    return (
        numbered.groupBy(*names, "run")
        .agg(
            F.min("stockout_start").alias("stockout_start"),
            F.max("stockout_end").alias("stockout_end"),
            F.sum("stockout_days").alias("stockout_days"),
            F.sum("cancelled_quantity").alias("cancelled_quantity"),
        )
        .select(*found.columns)
    )
