"""How the checked tables are derived and stored."""

import random
import re
from datetime import date, timedelta
from pathlib import Path

import pytest
from conftest import STAR

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks import mart, queries
from stockrecon.functions import expressions as X
from stockrecon.operators import reconcile
from stockrecon.operators.series import SERIES
from stockrecon.plans import analysis
from stockrecon.schemas import TABLES
from stockrecon.session import new_folder
from stockrecon.sources import tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    kept = {key: spark.conf.get(key) for key in keys}
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key, value in kept.items():
        spark.conf.set(key, value)


def test_counted_days_are_not_shuffled(spark, tmp_path):
    """Days become seven after the last shuffle."""
    lines = [(i, 1 + i % 3, 1 + i % 2, 5, 10, 500, 0, "NAR"[i % 3], "FO"[i % 2]) for i in range(30)]
    schema = "line_id long, branch_id long, product_id long, supplier_id long, units long, cents long, discount long, flag string, status string"
    booked = spark.createDataFrame(lines, schema).selectExpr("*", "date_add(DATE'2024-01-01', cast(line_id % 11 as int)) AS day")
    text = plan(mart.snapshots(booked))
    assert "Exchange" in text and not re.search("Exchange(?!.*REPARTITION)", text[: text.index("Generate explode")])


def test_snapshots_are_read_without_a_shuffle(no_broadcast, spark, inventory):
    views = analysis.views(inventory)
    for name in ("inventory_reconciliation", "phantom_inventory", "stockout_days", "lost_sales_estimate"):
        lines = re.sub(r"#\d+L?", "", plan(views[name])).splitlines()
        (scan,) = [n for n, line in enumerate(lines) if "recorded_closing_stock] Batched" in line]
        assert "Bucketed: true" in lines[scan]
        depth = lines[scan].index("FileScan")
        for line in reversed(lines[:scan]):
            start = len(line) - len(line.lstrip(" :+-"))
            if start < depth:
                depth = start
                if "Join" in line:  # the first join on the series; names are joined above it
                    break
                assert "Exchange" not in line, (name, line)


def test_a_later_load_reads_snapshots_without_a_shuffle(no_broadcast, spark, inventory):
    """The stock carried over is brought to the stored snapshots, which stay where they are."""
    carried = spark.createDataFrame([(1, 1, date(1990, 1, 1), 5)], "branch_id long, product_id long, snapshot_date date, recorded_closing_stock long")
    lines = plan(reconcile.previous_stock(inventory["snapshots"], carried)).splitlines()
    (scan,) = [n for n, line in enumerate(lines) if "FileScan" in line]
    (join,) = [n for n, line in enumerate(lines) if "Join" in line]
    assert "Bucketed: true" in lines[scan] and join < scan
    assert not any("Exchange" in line for line in lines[join:scan]) and any("Exchange" in line for line in lines[scan:])


def test_a_scan_of_text_writes_its_own_table_only(spark, monkeypatch):
    folder = new_folder(spark, "only")
    monkeypatch.setattr(queries, "new_folder", lambda spark, label: folder)
    monkeypatch.setattr(queries, "_csv", {})
    found = queries.all_queries()["S1_scan_csv_suppliers"](spark, f"{STAR}/sf0.001")
    assert found.count() == mart.inventory(spark, f"{STAR}/sf0.001")["suppliers"].count() > 0
    assert [p.name for p in Path(folder).iterdir()] == ["suppliers.csv"]


def test_packed_text_holds_the_same_rows(spark, inventory, monkeypatch):
    monkeypatch.setattr(tables, "PACKED_ROWS", 400)
    target = new_folder(spark, "packed")
    one = inventory["sales"].coalesce(1)
    stored = tables.load_tables({"sales": one}, target, fmt="csv", compression="gzip")["sales"]
    files = sorted(Path(f"{target}/sales.csv").glob("part-*"))
    assert len(files) > 1 and all(f.name.endswith(".csv.gz") for f in files)
    assert stored.schema.names == TABLES["sales"].names
    assert stored.exceptAll(one).isEmpty() and one.exceptAll(stored).isEmpty()


def seven_times(booked):
    """Snapshots in the plain way: each change makes seven days, which are then summed and added up."""
    changes = mart.true_movements(booked).select(
        *SERIES, X.day_of(F.col("movement_time")).alias("day"), X.signed_quantity(F.col("movement_type"), F.col("quantity")).alias("net")
    )
    cancelled = mart.cancellations(booked).select(*SERIES, X.day_of(F.col("cancellation_time")).alias("day"), F.lit(0).alias("net"))
    by_day = changes.union(cancelled).groupBy(*SERIES, "day").agg(F.sum("net").alias("net"))
    ahead = by_day.withColumn("ahead", F.explode(F.sequence(F.lit(0), F.lit(mart.COUNTED_DAYS - 1))))
    counted = ahead.groupBy(*SERIES, F.date_add("day", F.col("ahead")).alias("snapshot_date")).agg(
        F.sum(F.when(F.col("ahead") == 0, F.col("net")).otherwise(0)).alias("net")
    )
    number = F.datediff("snapshot_date", F.lit("1970-01-01").cast("date")).cast("bigint")
    loses = (31 * F.col("branch_id") + 17 * F.col("product_id") + number) % mart.SHRINK_CYCLE == 0
    change = F.col("net") - F.when(loses, mart.SHRINK_UNITS).otherwise(0)
    so_far = Window.partitionBy(*SERIES).orderBy("snapshot_date").rowsBetween(Window.unboundedPreceding, 0)
    return counted.select(
        ((F.col("product_id") * 1000 + F.col("branch_id")) * 100000 + number).alias("snapshot_id"),
        *SERIES, "snapshot_date", F.greatest(F.lit(0), F.sum(change).over(so_far)).alias("recorded_closing_stock"), loses.alias("loses"),
    )


def random_lines(spark, seed, first, days, series):
    rng = random.Random(seed)
    some = lambda value, share=0.05: None if rng.random() < share else value
    rows = [
        (some(i), some(rng.randrange(1, 4)), some(rng.randrange(1, series)), 5, some(rng.randrange(60), 0.3), 500, some(rng.randrange(10)),
         some(rng.choice("NAR")), some(rng.choice("OF")), some(first + timedelta(rng.randrange(days))))
        for i in range(1500)
    ]
    schema = "line_id long, branch_id long, product_id long, supplier_id long, units long, cents long, discount long, flag string, status string, day date"
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("seed,first,days,series", [(1, date(2020, 1, 1), 90, 4), (2, date(1969, 11, 1), 500, 30)])
def test_counted_days_are_those_of_the_plain_way(spark, seed, first, days, series):
    booked = random_lines(spark, seed, first, days, series)
    found, expected = mart.snapshots(booked, 3).collect(), seven_times(booked).collect()
    assert sorted(map(str, found)) == sorted(map(str, expected)) and any(r.loses for r in found)


def test_counted_days_are_not_sorted_or_summed(spark):
    """Windows run over the changes; nothing but the explosion handles up to seven days of each."""
    text = plan(mart.snapshots(random_lines(spark, 3, date(2020, 1, 1), 90, 4)))
    above = text[: text.index("Generate explode")]
    assert not re.search("Sort|Aggregate|Window", above)
