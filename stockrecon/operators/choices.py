"""One small table from which every choice of filters over the issues is answered.

Issues are grouped once by all dimensions; the sets of fewer dimensions are made from those
groups, so the issues themselves are neither copied per set nor read again. The table has at most
the product of (values + 1) over the dimensions as rows, however many issues there are. A choice
reads the rows of one set, those of the dimensions it names.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockrecon.functions import expressions as X
from stockrecon.operators.reports import filter_in

DIMENSIONS = ("branch_name", "probable_issue", "issue_severity")
_MEASURES = ("issue_count", "units_affected")


def _level(dimensions: Sequence[str]) -> int:
    """The number ``grouping_id`` gives to the set that keeps these dimensions."""
    return sum(1 << place for place, name in enumerate(reversed(DIMENSIONS)) if name not in dimensions)


def issue_summary(issues: DataFrame) -> DataFrame:
    """``level``, the dimensions, ``issue_count`` and ``units_affected`` for every set of dimensions.

    ``level`` tells the sets apart, so a missing value in a dimension remains a value of its own.
    """
    finest = issues.groupBy(*DIMENSIONS).agg(
        F.count(F.lit(1)).alias("issue_count"),
        F.sum(X.absolute_difference(F.col("stock_difference"))).alias("units_affected"),
    )
    sums = [F.sum(name).alias(name) for name in _MEASURES]
    return finest.cube(*DIMENSIONS).agg(F.grouping_id().alias("level"), *sums).select("level", *DIMENSIONS, *_MEASURES)


def _total(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0).cast("bigint")).alias(name)


def choose(summary: DataFrame, by: Sequence[str] = (), **chosen: list[str] | None) -> DataFrame:
    """Issues and units by the dimensions ``by`` within the chosen values; an empty choice keeps all.

    ``choose(summary, ["issue_severity"], branch_name=["North", "South"])``. Without ``by`` it is
    one row, with zeros where nothing was chosen that exists.
    """
    if unknown := {*by, *chosen} - {*DIMENSIONS}:
        raise ValueError(f"not among the dimensions {DIMENSIONS}: {sorted(unknown)}")
    named = {*by, *(name for name, values in chosen.items() if values)}
    rows = summary.where(F.col("level") == _level(tuple(named)))
    for name, values in chosen.items():
        rows = filter_in(rows, name, values)
    return rows.groupBy(*by).agg(*(_total(name) for name in _MEASURES))


def options(summary: DataFrame, dimension: str) -> DataFrame:
    """The values that can be chosen, sorted."""
    return choose(summary, [dimension]).select(dimension).dropna().orderBy(dimension)
