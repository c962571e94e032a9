"""Sales lost on days without stock, from the same weekday of earlier weeks."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockrecon import labels as L
from stockrecon.functions import expressions as X
from stockrecon.operators.series import SERIES, by_series, left_join_zero
from stockrecon.schemas import MONEY, RESULTS, UNITS


def lookback_days(weeks: int = L.LOOKBACK_WEEKS) -> list[int]:
    """Distances in days to the compared weekdays."""
    return [7 * week for week in range(1, weeks + 1)]


def demand_by_day(daily_sales: DataFrame, weeks: int = L.LOOKBACK_WEEKS) -> DataFrame:
    """Actual units of each day and the sum of units over its look-back days.

    Instead of looking back from every stockout day, each day of sales is carried forward
    to itself and to the days that will look back at it. Rows are laid out by series
    first, so the carried rows are summed where they are made.
    """
    forward = F.explode(F.array(*[F.lit(days) for days in (0, *lookback_days(weeks))]))
    sold = by_series(daily_sales.select(*SERIES, "sale_date", "units_sold"), "sale_date", "sold_on")
    today = F.col("ahead") == 0
    carried = sold.withColumn("ahead", forward)
    return carried.groupBy(*SERIES, F.date_add("sold_on", F.col("ahead")).alias("stockout_date")).agg(
        F.sum(F.when(today, F.col("units_sold"))).alias("actual_units_sold"),
        F.sum(F.when(~today, F.col("units_sold"))).alias("lookback_units"),
    )


def expected_units(days: DataFrame, daily_sales: DataFrame, weeks: int = L.LOOKBACK_WEEKS) -> DataFrame:
    """Add actual and expected units; expected is the mean of the weeks, missing days as 0."""
    joined = left_join_zero(
        days, demand_by_day(daily_sales, weeks), "stockout_date", ["actual_units_sold", "lookback_units"]
    )
    mean = F.col("lookback_units").cast("decimal(16,0)") / F.lit(weeks).cast("decimal(4,0)")
    return joined.withColumn("expected_units", mean.cast(UNITS)).drop("lookback_units")


def lost_sales_estimate(
    days: DataFrame, daily_sales: DataFrame, products: DataFrame, weeks: int = L.LOOKBACK_WEEKS
) -> DataFrame:
    """Units, revenue and gross profit lost on each stockout day.

    Each amount is rounded once, from unrounded units.
    """
    demand = expected_units(days, daily_sales, weeks)
    prices = products.select("product_id", "unit_cost", "selling_price")
    lost = X.lost_units(
        F.col("cancelled_quantity").cast(UNITS), F.col("expected_units"), F.col("actual_units_sold").cast(UNITS)
    ).cast(UNITS)
    margin = F.col("selling_price") - F.col("unit_cost")
    return (
        demand.join(prices, "product_id")
        .withColumn("estimated_lost_units", lost)
        .withColumn(
            "estimated_lost_revenue",
            X.round2(F.col("estimated_lost_units") * F.col("selling_price")).cast(MONEY),
        )
        .withColumn("estimated_lost_gross_profit", X.round2(F.col("estimated_lost_units") * margin).cast(MONEY))
        .select(*RESULTS["lost_sales_estimate"].names)
    )
