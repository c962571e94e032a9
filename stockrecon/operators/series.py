"""Keys shared by all operators, and how rows are laid out on them.

A *series* is one product in one branch. Raw facts are first summed per series and day
(partial sums on the map side, shuffled on all three keys), so a series that holds a large
share of all facts never meets in one task. What is left has at most one row per series and
calendar day. Only such daily rows are gathered per series, which bounds every window
below by the number of days on record.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockrecon.functions.expressions import or_zero

SERIES = ["branch_id", "product_id"]
BRANCH_COLUMNS = ["branch_id", "branch_name"]
PRODUCT_COLUMNS = ["product_id", "sku", "product_name", "category"]


def by_series(daily: DataFrame, day: str, as_day: str, parts: int | None = None) -> DataFrame:
    """Lay a daily aggregate out by series, in ``parts`` if given, and name its day for a join.

    The renaming comes last on purpose: a join prefers the layout of a side that does not
    end in a shuffle of its own, so the other side is shuffled by series as well (or not at
    all if it is stored that way), and later windows and groupings reuse that layout.
    """
    laid_out = daily.repartition(*SERIES) if parts is None else daily.repartition(parts, *SERIES)
    return laid_out.select(*[F.col(name).alias(as_day if name == day else name) for name in daily.columns])


def join_bpd(left: DataFrame, right: DataFrame, day: str, how: str = "inner") -> DataFrame:
    """Equi-join of two frames on branch, product and day."""
    return left.join(right, [*SERIES, day], how)


def left_join_zero(left: DataFrame, right: DataFrame, day: str, columns: list[str]) -> DataFrame:
    """Left join on branch, product and day; absent measures become 0."""
    joined = join_bpd(left, right, day, "left")
    return joined.withColumns({name: or_zero(F.col(name)) for name in columns})


def with_dims(fact: DataFrame, branches: DataFrame, products: DataFrame, *more: str) -> DataFrame:
    """Add names, and ``more`` product columns; rows of unknown branches or products drop out.

    No broadcast hint: Spark broadcasts a dimension if its estimated or, at run time, its
    measured size is below the thresholds of the session, and sort-merges it otherwise.
    """
    return fact.join(branches.select(*BRANCH_COLUMNS), "branch_id").join(
        products.select(*PRODUCT_COLUMNS, *more), "product_id"
    )


def daily(fact: DataFrame, day: Column, name: str, *measures: Column) -> DataFrame:
    """Sum a fact table per series and calendar day."""
    return fact.groupBy(*SERIES, day.alias(name)).agg(*measures)
