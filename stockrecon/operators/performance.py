"""Supplier reliability and branch risk."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockrecon.functions import expressions as X
from stockrecon.schemas import RESULTS


def supplier_performance(orders: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Punctuality, fill rate and mean delay of each supplier that has orders.

    Orders are summed per supplier before the names are joined.
    """
    actual, expected = F.col("actual_delivery_date"), F.col("expected_delivery_date")
    total = F.count(F.lit(1))
    rated = orders.groupBy("supplier_id").agg(
        total.alias("total_orders"),
        X.count_where(X.is_late(actual, expected)).alias("late_orders"),
        X.round2(X.pct(X.count_where(X.is_on_time(actual, expected)), total)).alias("on_time_delivery_rate"),
        X.round2(X.pct(F.sum("received_quantity"), F.sum("ordered_quantity"))).alias("fill_rate"),
        X.round2(F.avg(X.delay_days(actual, expected))).alias("average_delay_days"),
    )
    return suppliers.select("supplier_id", "supplier_name").join(rated, "supplier_id")


def branch_reconciliation(recon: DataFrame) -> DataFrame:
    """Snapshots, issues and absolute difference per branch."""
    difference = F.col("stock_difference")
    return recon.groupBy("branch_id").agg(
        F.count(F.lit(1)).alias("snapshots"),
        X.count_where(difference != 0).alias("issue_count"),
        F.sum(X.absolute_difference(difference)).alias("absolute_stock_difference"),
    )


def branch_phantom(phantom: DataFrame) -> DataFrame:
    return phantom.groupBy("branch_id").agg(F.count(F.lit(1)).alias("phantom_incidents"))


def branch_lost(lost: DataFrame) -> DataFrame:
    return lost.groupBy("branch_id").agg(
        F.sum("estimated_lost_revenue").alias("estimated_lost_revenue"),
        F.sum("estimated_lost_gross_profit").alias("estimated_lost_gross_profit"),
    )


def branch_sums(recon: DataFrame, phantom: DataFrame, lost: DataFrame) -> DataFrame:
    """All per-branch sums in one row per branch that has any; sums of sums are sums again."""
    return (
        branch_reconciliation(recon)
        .join(branch_phantom(phantom), "branch_id", "full")
        .join(branch_lost(lost), "branch_id", "full")
    )


def assemble_branch(branches: DataFrame, recon: DataFrame, phantom: DataFrame, lost: DataFrame) -> DataFrame:
    """Join the per-branch sums; a branch needs snapshots but neither phantom nor lost rows."""
    return _assembled(
        branches.select("branch_id", "branch_name", "region")
        .join(branch_reconciliation(recon), "branch_id")
        .join(branch_phantom(phantom), "branch_id", "left")
        .join(branch_lost(lost), "branch_id", "left")
    )


def _assembled(summed: DataFrame) -> DataFrame:
    money = "decimal(28,2)"
    return summed.withColumns(
        {
            "reconciliation_issue_rate": X.round2(X.pct(F.col("issue_count"), F.col("snapshots"))),
            "phantom_incidents": X.or_zero(F.col("phantom_incidents")),
            "estimated_lost_revenue": F.coalesce("estimated_lost_revenue", F.lit(0).cast(money)).cast(money),
            "estimated_lost_gross_profit": F.coalesce("estimated_lost_gross_profit", F.lit(0).cast(money)).cast(money),
        }
    )


def health_of_sums(branches: DataFrame, parts: DataFrame) -> DataFrame:
    """Branch health from stored ``branch_sums`` of any number of loads; views are not read again."""
    measures = [name for name in parts.columns if name != "branch_id"]
    summed = parts.groupBy("branch_id").agg(*(F.sum(name).alias(name) for name in measures))
    known = branches.select("branch_id", "branch_name", "region").join(summed.where("snapshots > 0"), "branch_id")
    return risk_rank(_assembled(known)).select(*RESULTS["branch_inventory_health"].names)


def risk_rank(health: DataFrame) -> DataFrame:
    """Rank branches by lost revenue, then by number of issues; ties share a rank.

    The window has no partition: its input is one row per branch, already summed.
    """
    worst_first = Window.orderBy(F.desc("estimated_lost_revenue"), F.desc("issue_count"))
    return health.withColumn("risk_rank", F.rank().over(worst_first).cast("bigint"))


def branch_inventory_health(
    branches: DataFrame, recon: DataFrame, phantom: DataFrame, lost: DataFrame
) -> DataFrame:
    return risk_rank(assemble_branch(branches, recon, phantom, lost)).select(
        *RESULTS["branch_inventory_health"].names
    )
