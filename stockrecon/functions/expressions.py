"""Scalar rules of the stock model, all built from JVM-side functions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockrecon import labels as L

def zero() -> Column:
    return F.lit(0).cast("bigint")


# ---- days ---------------------------------------------------------------------------


def day_of(moment: Column) -> Column:
    """Calendar day of a timestamp or of ISO text; NULL for text that is no date."""
    return moment.try_cast("date")


def shift_days(day: Column, days: int) -> Column:
    return F.date_add(day, days)


def island_id(day: Column, number: Column) -> Column:
    """Constant along consecutive days when ``number`` counts the rows of a series."""
    return F.date_sub(day, number.cast("int"))


def delay_days(actual: Column, expected: Column) -> Column:
    """Whole days of delay, negative when early."""
    return F.datediff(actual, expected)


def is_late(actual: Column, expected: Column) -> Column:
    return actual > expected


def is_on_time(actual: Column, expected: Column) -> Column:
    return actual <= expected


# ---- numbers ------------------------------------------------------------------------


def round2(value: Column) -> Column:
    """Two places, half away from zero; exact on decimals."""
    return F.round(value, 2)


def round2_half_even(value: Column) -> Column:
    return F.bround(value, 2)


def pct(part: Column, whole: Column) -> Column:
    """Percentage as a double; NULL for an empty whole."""
    return F.try_divide(F.lit(100.0) * part, whole)


def or_zero(value: Column) -> Column:
    return F.coalesce(value, zero())


def count_where(condition: Column) -> Column:
    """Number of rows where the condition holds; NULL counts as no."""
    return F.count_if(condition)


def absolute_difference(difference: Column) -> Column:
    return F.abs(difference)


def lost_units(cancelled: Column, expected: Column, actual: Column) -> Column:
    """Units not sold: the larger of what was refused and what was missed, never negative."""
    return F.greatest(cancelled, expected - actual, F.lit(0))


# ---- movements ----------------------------------------------------------------------


def inflow_quantity(movement_type: Column, quantity: Column) -> Column:
    return F.when(movement_type.isin(*L.INFLOW_TYPES), quantity).otherwise(zero())


def outflow_quantity(movement_type: Column, quantity: Column) -> Column:
    return F.when(movement_type.isin(*L.OUTFLOW_TYPES), quantity).otherwise(zero())


def signed_quantity(movement_type: Column, quantity: Column) -> Column:
    """Positive for the inflow types; any other type takes stock away."""
    return F.when(movement_type.isin(*L.INFLOW_TYPES), quantity).otherwise(-quantity)


def supplier_reference(order_id: Column) -> Column:
    return F.concat(F.lit(L.SUPPLIER_REFERENCE_PREFIX), order_id.cast("string"))


# ---- classification -----------------------------------------------------------------


def expected_stock(previous: Column, net: Column) -> Column:
    return or_zero(previous) + net


def reconciliation_status(recorded: Column, expected: Column) -> Column:
    return (
        F.when(recorded == expected, L.RECONCILED)
        .when(recorded > expected, L.RECORDED_EXCEEDS)
        .otherwise(L.LEDGER_EXCEEDS)
    )


def issue_severity(difference: Column) -> Column:
    size = F.abs(difference)
    (name, bound), *smaller = L.SEVERITY_BOUNDS
    grade = F.when(size >= bound, name)
    for name, bound in smaller:
        grade = grade.when(size >= bound, name)
    return grade.otherwise(L.LOWEST_SEVERITY)


def probable_issue(difference: Column, duplicates: Column, deliveries: Column, inflow: Column) -> Column:
    """Likely cause of a difference.

    A surplus copy explains only missing stock; a forgotten delivery explains extra stock
    only on a day on which nothing at all was booked in.
    """
    short, over = difference < 0, difference > 0
    return (
        F.when(short & (duplicates > 0), L.DUPLICATE_MOVEMENT)
        .when(over & (deliveries > 0) & (inflow == 0), L.MISSING_DELIVERY)
        .when(short, L.SHRINKAGE)
        .when(over, L.UNRECORDED_INFLOW)
    )
