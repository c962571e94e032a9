"""Daily totals of the five fact tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockrecon.functions import expressions as X
from stockrecon.operators.series import daily


def daily_sales(sales: DataFrame) -> DataFrame:
    """Units and revenue sold per branch, product and day."""
    return daily(
        sales,
        X.day_of(F.col("sale_time")),
        "sale_date",
        F.sum("quantity").alias("units_sold"),
        X.round2(F.sum("revenue")).alias("revenue"),
    )


def daily_movements(movements: DataFrame) -> DataFrame:
    """Stock booked in, booked out and net per branch, product and day."""
    kind, quantity = F.col("movement_type"), F.col("quantity")
    return daily(
        movements,
        X.day_of(F.col("movement_time")),
        "movement_date",
        F.sum(X.inflow_quantity(kind, quantity)).alias("inflow_quantity"),
        F.sum(X.outflow_quantity(kind, quantity)).alias("outflow_quantity"),
        F.sum(X.signed_quantity(kind, quantity)).alias("net_movement"),
    )


def delivery_days(orders: DataFrame) -> DataFrame:
    """Number of supplier orders delivered per branch, product and day."""
    return daily(
        orders, F.col("actual_delivery_date"), "issue_date", F.count(F.lit(1)).alias("delivery_count")
    )


def cancelled_by_day(cancellations: DataFrame, reason: str | None = None) -> DataFrame:
    """Quantity of cancelled sales per branch, product and day, for one reason or for all."""
    if reason is not None:
        cancellations = cancellations.where(F.col("reason") == reason)
    return daily(
        cancellations,
        X.day_of(F.col("cancellation_time")),
        "cancellation_date",
        F.sum("requested_quantity").alias("cancelled_quantity"),
    )
