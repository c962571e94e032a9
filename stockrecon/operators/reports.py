"""Reports, key figures and the data sets behind a dashboard.

Rankings that are cut to n rows carry key columns as tie-breakers, so that the cut is the
same on every run.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockrecon import labels as L
from stockrecon.functions import expressions as X
from stockrecon.operators.series import SERIES

_CASE = [*SERIES, "snapshot_date"]
_ISSUE = ["issue_type", *SERIES, "issue_date"]


# ---- issues -------------------------------------------------------------------------


def issue_mix(issues: DataFrame) -> DataFrame:
    """Issues and units by cause and severity, most frequent first."""
    mix = issues.groupBy("probable_issue", "issue_severity").agg(
        F.count(F.lit(1)).alias("issue_count"),
        F.sum(X.absolute_difference(F.col("stock_difference"))).alias("units_affected"),
    )
    return mix.orderBy(F.desc("issue_count"), "probable_issue", "issue_severity")


def cause_counts(issues: DataFrame) -> DataFrame:
    counts = issues.groupBy("probable_issue").agg(F.count(F.lit(1)).alias("issue_count"))
    return counts.orderBy(F.desc("issue_count"), "probable_issue")


def severity_mix(issues: DataFrame) -> DataFrame:
    counts = issues.groupBy("issue_severity").agg(F.count(F.lit(1)).alias("issue_count"))
    return counts.orderBy(F.desc("issue_count"), "issue_severity")


def largest_differences(issues: DataFrame) -> DataFrame:
    return issues.orderBy(X.absolute_difference(F.col("stock_difference")).desc(), *_CASE)


def top_differences(issues: DataFrame, n: int = 100) -> DataFrame:
    size = X.absolute_difference(F.col("stock_difference"))
    return issues.withColumn("absolute_difference", size).orderBy(F.desc("absolute_difference"), *_CASE).limit(n)


# ---- phantom stock, stockouts, lost sales -------------------------------------------


def phantom_by_value(phantom: DataFrame) -> DataFrame:
    return phantom.orderBy(F.desc("directly_observed_lost_revenue"), *_CASE)


def top_phantom(phantom: DataFrame, n: int = 20) -> DataFrame:
    return phantom_by_value(phantom).limit(n)


def longest_stockouts(periods: DataFrame) -> DataFrame:
    return periods.orderBy(F.desc("stockout_days"), F.desc("cancelled_quantity"), *SERIES, "stockout_start")


def lost_by_value(lost: DataFrame) -> DataFrame:
    return lost.orderBy(F.desc("estimated_lost_revenue"), *SERIES, "stockout_date")


def category_lost_revenue(lost: DataFrame) -> DataFrame:
    by_category = lost.groupBy("category").agg(
        X.round2(F.sum("estimated_lost_revenue")).alias("estimated_lost_revenue")
    )
    return by_category.orderBy(F.desc("estimated_lost_revenue"), "category")


# ---- suppliers and branches ---------------------------------------------------------


def supplier_league(performance: DataFrame) -> DataFrame:
    return performance.orderBy("on_time_delivery_rate", "fill_rate", "supplier_id")


def supplier_on_time(performance: DataFrame) -> DataFrame:
    chosen = performance.select("supplier_id", "supplier_name", "on_time_delivery_rate")
    return order_for_chart(chosen, "on_time_delivery_rate", False, "supplier_id").drop("supplier_id")


def supplier_fill(performance: DataFrame) -> DataFrame:
    chosen = performance.select("supplier_id", "supplier_name", "fill_rate")
    return order_for_chart(chosen, "fill_rate", False, "supplier_id").drop("supplier_id")


def branch_ranking(health: DataFrame) -> DataFrame:
    return health.orderBy("risk_rank", "branch_id")


def top_branches(health: DataFrame, n: int = 10) -> DataFrame:
    return branch_ranking(health).limit(n)


def branch_risk_table(health: DataFrame, branches: list[str] | None = None) -> DataFrame:
    """Risk table of the chosen branches, cheapest branch first."""
    wanted = ["risk_rank", "branch_name", "issue_count", "phantom_incidents", "estimated_lost_revenue"]
    table = select_present(filter_in(health, "branch_name", branches), wanted)
    return order_for_chart(table, "estimated_lost_revenue", False, "branch_name")


# ---- selection ----------------------------------------------------------------------


def filter_in(df: DataFrame, column: str, values: list[str] | None) -> DataFrame:
    """Keep the chosen values; an empty choice keeps everything."""
    return df.where(F.col(column).isin(*values)) if values else df


def filter_options(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).dropna().distinct().orderBy(column)


def select_present(df: DataFrame, wanted: list[str]) -> DataFrame:
    return df.select(*[name for name in wanted if name in df.columns])


def order_for_chart(df: DataFrame, column: str, descending: bool, *ties: str) -> DataFrame:
    """Sort for a chart; missing values come last either way."""
    key = F.col(column).desc_nulls_last() if descending else F.col(column).asc_nulls_last()
    return df.orderBy(key, *ties)


# ---- recall against known issues ----------------------------------------------------


def union_distinct(dfs: list[DataFrame], columns: list[str]) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.select(*columns) for df in dfs]).dropDuplicates()


def flag_matches(known: DataFrame, detected: DataFrame, keys: list[str]) -> DataFrame:
    """Add 1 where the key was detected, else 0; ``detected`` holds each key once."""
    hits = detected.select(*keys).withColumn("_hit", F.lit(True))
    flagged = known.join(hits, keys, "left")
    return flagged.withColumn("detected", F.col("_hit").isNotNull().cast("int")).drop("_hit")


def detected_issues(
    phantom: DataFrame, surplus: DataFrame, unbooked: DataFrame, issues: DataFrame
) -> DataFrame:
    """What the four detectors report, each branch, product and day once.

    A missing delivery is an order without a movement, whatever the stock looks like.
    """
    copied = surplus.withColumn("issue_type", F.lit(L.DUPLICATE_MOVEMENT))
    missing = unbooked.select(
        F.lit(L.MISSING_DELIVERY).alias("issue_type"), *SERIES, F.col("actual_delivery_date").alias("issue_date")
    )
    shown = phantom.select(F.lit(L.PHANTOM).alias("issue_type"), *SERIES, F.col("snapshot_date").alias("issue_date"))
    shrunk = issues.where(F.col("probable_issue") == L.SHRINKAGE).select(
        F.col("probable_issue").alias("issue_type"), *SERIES, F.col("snapshot_date").alias("issue_date")
    )
    return union_distinct([shown, copied, missing, shrunk], _ISSUE)


def recall(known: DataFrame, detected: DataFrame) -> DataFrame:
    """Share of known issues that were detected, per type; extra detections do not count.

    Equal labels are counted before the join, so a label that repeats often stays one row.
    """
    labels = known.groupBy(*_ISSUE).agg(F.count("issue_date").alias("expected"), F.count(F.lit(1)).alias("rows"))
    flagged = flag_matches(labels, detected, _ISSUE)
    summary = (
        flagged.where(F.col("issue_type").isNotNull())
        .groupBy("issue_type")
        .agg(
            F.sum("expected").alias("expected_issues"),
            F.sum(F.col("rows") * F.col("detected")).alias("detected_issues"),
        )
    )
    rate = X.round2_half_even(X.pct(F.col("detected_issues"), F.col("expected_issues")))
    return summary.withColumn("detection_rate", rate)


def validation_summary(
    known: DataFrame, phantom: DataFrame, surplus: DataFrame, unbooked: DataFrame, issues: DataFrame
) -> DataFrame:
    return recall(known, detected_issues(phantom, surplus, unbooked, issues))


# ---- key figures --------------------------------------------------------------------


def one_row(**scalars: tuple[DataFrame, Column]) -> DataFrame:
    """Combine global aggregates of different frames into one row.

    Each aggregate fills its own column of a union of one-row frames, which is then folded
    by a maximum, so no product of frames is formed.
    """
    totals = [df.agg(value.alias(name)) for name, (df, value) in scalars.items()]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), totals)
    return stacked.agg(*[F.max(name).alias(name) for name in scalars])


def _rows() -> Column:
    return F.count(F.lit(1))


def _revenue() -> Column:
    return F.coalesce(X.round2(F.sum("estimated_lost_revenue")), F.lit(0).cast("decimal(28,2)"))


def executive_kpis(
    snapshots: DataFrame, issues: DataFrame, phantom: DataFrame, surplus: DataFrame, lost: DataFrame
) -> DataFrame:
    return one_row(
        snapshots=(snapshots, _rows()),
        issues=(issues, _rows()),
        phantom=(phantom, _rows()),
        duplicates=(surplus, F.coalesce(F.sum("duplicate_count"), X.zero())),
        lost_revenue=(lost, _revenue()),
    )


def dashboard_kpis(
    issues: DataFrame,
    phantom: DataFrame,
    lost: DataFrame,
    validation: DataFrame,
    performance: DataFrame,
    severities: list[str] | None = None,
) -> DataFrame:
    """Key figures of the dashboard; only the issue count follows the severity choice."""
    return one_row(
        issue_count=(filter_in(issues, "issue_severity", severities), _rows()),
        phantom_cases=(phantom, _rows()),
        lost_revenue=(lost, _revenue()),
        average_detection=(validation, F.coalesce(F.avg("detection_rate"), F.lit(0.0))),
        average_on_time=(performance, F.coalesce(F.avg("on_time_delivery_rate"), F.lit(0.0))),
    )


def stored_kpis(counted: DataFrame, health: DataFrame, validation: DataFrame, performance: DataFrame) -> DataFrame:
    """``dashboard_kpis`` without a choice, from counted issues and branch health.

    Health sums up phantom cases and lost revenue per branch; a branch that is listed more than
    once has the same sums in each row.
    """
    branches = health.dropDuplicates(["branch_id"])
    return one_row(
        issue_count=(counted, F.max("issue_count")),
        phantom_cases=(branches, F.coalesce(F.sum("phantom_incidents"), X.zero())),
        lost_revenue=(branches, _revenue().cast("decimal(29,2)")),
        average_detection=(validation, F.coalesce(F.avg("detection_rate"), F.lit(0.0))),
        average_on_time=(performance, F.coalesce(F.avg("on_time_delivery_rate"), F.lit(0.0))),
    )
