from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stockrecon.functions import expressions as X


def value(spark, column):
    return spark.range(1).select(column.alias("v")).collect()[0].v


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2025-01-05 23:59:59", date(2025, 1, 5)),
        ("2025-01-05", date(2025, 1, 5)),
        ("2024-02-29 00:00:00", date(2024, 2, 29)),
        ("2025-02-30", None),
        ("rubbish", None),
        ("", None),
        (None, None),
    ],
)
def test_day_of_text(spark, text, expected):
    assert value(spark, X.day_of(F.lit(text).cast("string"))) == expected


def test_day_of_timestamp(spark):
    assert value(spark, X.day_of(F.expr("TIMESTAMP_NTZ '2025-03-01 23:00:00'"))) == date(2025, 3, 1)


@pytest.mark.parametrize(
    "difference, severity",
    [(4, "Low"), (-4, "Low"), (5, "Medium"), (-9, "Medium"), (10, "High"), (-24, "High"), (25, "Critical"), (-99, "Critical")],
)
def test_severity(spark, difference, severity):
    assert value(spark, X.issue_severity(F.lit(difference))) == severity


@pytest.mark.parametrize(
    "difference, duplicates, deliveries, inflow, cause",
    [
        (-3, 1, 0, 5, "Duplicate inventory movement"),
        (3, 1, 0, 5, "Possible unrecorded inflow or count error"),
        (3, 0, 1, 0, "Missing delivery movement"),
        (3, 0, 1, 2, "Possible unrecorded inflow or count error"),
        (-3, 0, 1, 0, "Possible shrinkage or missing outflow"),
        (0, 1, 1, 0, None),
    ],
)
def test_probable_issue(spark, difference, duplicates, deliveries, inflow, cause):
    column = X.probable_issue(F.lit(difference), F.lit(duplicates), F.lit(deliveries), F.lit(inflow))
    assert value(spark, column) == cause


def test_expected_stock_without_previous(spark):
    assert value(spark, X.expected_stock(F.lit(None).cast("bigint"), F.lit(7))) == 7
    assert value(spark, X.expected_stock(F.lit(3), F.lit(-7))) == -4


def test_rounding_and_rates(spark):
    assert value(spark, X.round2(F.lit(Decimal("0.125")))) == Decimal("0.13")
    assert value(spark, X.round2_half_even(F.lit(Decimal("0.125")))) == Decimal("0.12")
    assert value(spark, X.pct(F.lit(1), F.lit(8))) == 12.5
    assert value(spark, X.pct(F.lit(1), F.lit(0))) is None


def test_dates(spark):
    a, b = F.lit("2025-03-01").cast("date"), F.lit("2025-02-27").cast("date")
    assert value(spark, X.delay_days(a, b)) == 2
    assert value(spark, X.delay_days(b, a)) == -2
    assert value(spark, X.is_late(a, b)) and not value(spark, X.is_late(a, a))
    assert value(spark, X.is_on_time(a, a)) and not value(spark, X.is_on_time(a, b))
    assert value(spark, X.shift_days(a, -7)) == date(2025, 2, 22)
    assert value(spark, X.island_id(a, F.lit(1))) == date(2025, 2, 28)


def test_lost_units(spark):
    def lost(cancelled, expected, actual):
        return value(spark, X.lost_units(F.lit(cancelled), F.lit(expected), F.lit(actual)))

    assert lost(5, 2, 0) == 5
    assert lost(1, 9, 2) == 7
    assert lost(0, 1, 6) == 0
