"""Tables switch together, and only when all of them are written."""

import pytest
from pyspark.sql import functions as F

from stockrecon.session import new_folder
from stockrecon.sources import refresh


def frames(spark, a, b):
    return {"a": spark.range(a).toDF("x"), "b": spark.range(b).selectExpr("id AS y", "string(id) AS z")}


def sizes(spark, target, version=None):
    return {name: df.count() for name, df in refresh.current(spark, target, version).items()}


def failing(spark):
    """A frame that breaks while its last rows are written."""
    bad = F.when(F.col("id") > 90, F.raise_error(F.lit("broken row")).cast("bigint")).otherwise(F.col("id"))
    return spark.range(100).select(bad.alias("y"), F.col("id").cast("string").alias("z"))


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_refresh_that_fails_half_way_leaves_the_old_tables(spark, fmt):
    target = new_folder(spark, "refresh")
    refresh.refresh_tables(spark, frames(spark, 3, 4), target, fmt)
    with pytest.raises(Exception, match="broken row"):
        refresh.refresh_tables(spark, frames(spark, 30, 40) | {"b": failing(spark)}, target, fmt)
    assert sizes(spark, target) == {"a": 3, "b": 4}
    stored = refresh.refresh_tables(spark, frames(spark, 5, 6), target, fmt)
    assert {name: df.count() for name, df in stored.items()} == sizes(spark, target) == {"a": 5, "b": 6}
    assert sizes(spark, target, 1) == {"a": 3, "b": 4}


def test_frames_of_an_old_version_stay_readable(spark):
    target = new_folder(spark, "refresh")
    old = refresh.refresh_tables(spark, frames(spark, 3, 4), target)
    refresh.refresh_tables(spark, frames(spark, 5, 6), target)
    assert old["a"].count() == 3


def test_a_table_may_be_replaced_by_what_it_holds(spark):
    target = new_folder(spark, "refresh")
    old = refresh.refresh_tables(spark, frames(spark, 3, 4), target)
    refresh.refresh_tables(spark, {"a": old["a"].union(old["a"])}, target)
    assert sizes(spark, target) == {"a": 6, "b": 4}


def test_rows_are_added_beside_the_old_ones(spark):
    target = new_folder(spark, "refresh")
    refresh.refresh_tables(spark, frames(spark, 3, 4), target)
    load = refresh.Load(spark, target)
    load.write("a", spark.range(10, 12).toDF("x"))
    load.write("b", spark.range(1).selectExpr("id AS y", "string(id) AS z"))
    assert sizes(spark, target) == {"a": 3, "b": 4}
    load.commit("noted", {"a"})
    assert sizes(spark, target) == {"a": 5, "b": 1} and refresh.note(spark, target) == "noted"
    assert {tuple(r) for r in refresh.row_counts(spark, target).collect()} == {("a", 5), ("b", 1)}
    other = refresh.Load(spark, target)
    other.write("a", spark.range(2).selectExpr("string(id) AS x"))
    with pytest.raises(ValueError, match="other columns"):
        other.commit(append={"a"})


def test_counts_while_writing(spark):
    target = new_folder(spark, "counted")
    ordered = spark.range(1000).repartition(7).orderBy(F.desc("id"))
    assert refresh.write_counted(ordered, f"{target}/x", "parquet") == 1000
    assert refresh.write_counted(spark.range(10).where("id < 0"), f"{target}/y", "parquet") == 0
    assert refresh.write_counted(spark.createDataFrame([], "x int"), f"{target}/z", "parquet") == 0


def test_nothing_there_yet(spark):
    target = new_folder(spark, "refresh")
    assert refresh.current(spark, target) == {} and refresh.note(spark, target) is None
    assert refresh.row_counts(spark, target).isEmpty() and refresh.forget(spark, target) == []


def test_forget_keeps_what_a_kept_version_names(spark):
    target = new_folder(spark, "refresh")
    for n in (1, 2, 3):
        refresh.refresh_tables(spark, frames(spark, n, n), target)
    load = refresh.Load(spark, target)
    load.write("a", spark.range(1).toDF("x"))
    load.commit(append={"a"})
    gone = refresh.forget(spark, target, keep=1)
    assert len(gone) == 4 and sizes(spark, target) == {"a": 4, "b": 3}
