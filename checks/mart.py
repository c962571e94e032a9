"""Inventory tables derived from a star schema of orders and line items.

The mapping is fixed and needs no random numbers, so another engine can derive the same
tables. It uses every line item, and every table grows with the star:

* a *line* is all line items that share order and line number, booked as one;
* a branch is a nation, a product a family of 100 consecutive parts;
* lines flagged N are sales, A are supplier orders, R are corrections or cancelled sales;
* snapshots exist on the day of a line and on the six days after it, so a series has
  unbroken runs as well as gaps;
* some deliveries are booked twice or thrice, some never, and some days lose six units.
"""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockrecon import labels as L
from stockrecon.functions import expressions as X
from stockrecon.operators.series import SERIES, by_series, daily
from stockrecon.schemas import KNOWN_ISSUES, MONEY, TABLES
from stockrecon.session import new_folder, shuffle_parts, tune
from stockrecon.sources.tables import load_tables, store_snapshots

# Fixed values of the mapping.
PARTS_PER_PRODUCT = 100
# A prime above any line number: ids are unique, and their remainders mix orders and lines.
LINES_PER_ORDER = 1009
NEVER_BOOKED = 37
BOOKED_TWICE = 41
BOOKED_THRICE = 82
COUNTED_DAYS = 7
#: Snapshots of a stored bucket, at most on average.
BUCKET_ROWS = 1_000_000
SHRINK_UNITS = 6
SHRINK_CYCLE = 193


def _whole(value: Column, divisor: int) -> Column:
    """Integer division of non-negative whole numbers."""
    return F.floor(value / divisor).cast("bigint")


def _hundredths(value: Column) -> Column:
    """A double with two decimals as a whole number of hundredths."""
    return F.round(value * 100).cast("bigint")


def _at(day: Column, hour: int) -> Column:
    return day.cast("timestamp_ntz") + F.expr(f"INTERVAL {hour} HOURS")


def _at_least_one(value: Column) -> Column:
    return F.greatest(F.lit(1).cast("bigint"), value)


def star(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _line_id(order: Column, line: Column) -> Column:
    """Fails where a line number is so large that ids would collide."""
    too_large = F.raise_error(F.concat(F.lit("line number out of range: "), line.cast("string")))
    return F.when((line < 0) | (line >= LINES_PER_ORDER), too_large).otherwise(order * LINES_PER_ORDER + line)


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order and line number, with branch and product.

    Line items are summed before any join, so an order or line that repeats without end is
    folded on the map side.
    """
    booked = (
        star(spark, folder, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(
            F.sum("l_quantity").cast("bigint").alias("units"),
            F.sum(_hundredths(F.col("l_extendedprice"))).alias("cents"),
            F.max(_hundredths(F.col("l_discount"))).alias("discount"),
            F.min("l_partkey").alias("part"),
            F.min("l_suppkey").alias("supplier_id"),
            # One-letter flags as numbers: a minimum of strings would need a sort.
            F.min(F.ascii("l_returnflag")).alias("flag"),
            F.min(F.ascii("l_linestatus")).alias("status"),
            F.min("l_shipdate").cast("date").alias("day"),
        )
    )
    orders = star(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customers = star(spark, folder, "customer").select("c_custkey", "c_nationkey")
    homes = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return booked.join(homes, F.col("l_orderkey") == F.col("o_orderkey")).select(
        _line_id(F.col("l_orderkey"), F.col("l_linenumber")).alias("line_id"),
        (F.col("c_nationkey") + 1).cast("bigint").alias("branch_id"),
        (_whole(F.col("part"), PARTS_PER_PRODUCT) + 1).alias("product_id"),
        "supplier_id",
        "units",
        "cents",
        "discount",
        F.char("flag").alias("flag"),
        F.char("status").alias("status"),
        "day",
    )


def dimensions(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    nations, regions = star(spark, folder, "nation"), star(spark, folder, "region")
    branches = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        (F.col("n_nationkey") + 1).cast("bigint").alias("branch_id"),
        F.col("n_name").alias("branch_name"),
        F.col("r_name").alias("region"),
    )
    suppliers = star(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("supplier_name")
    )
    price = F.col("p_retailprice").cast(MONEY)
    families = (
        star(spark, folder, "part")
        .groupBy((_whole(F.col("p_partkey"), PARTS_PER_PRODUCT) + 1).alias("product_id"))
        .agg(
            F.min_by("p_type", "p_partkey").alias("category"),
            F.min(price).alias("unit_cost"),
            F.max(price).alias("selling_price"),
        )
    )
    number = F.col("product_id").cast("string")
    products = families.select(
        "product_id",
        F.concat(F.lit("SKU-"), number).alias("sku"),
        F.concat("category", F.lit(" family "), number).alias("product_name"),
        "category",
        (F.col("product_id") % 10).alias("supplier_id"),
        "unit_cost",
        "selling_price",
        F.lit(10).cast("bigint").alias("reorder_point"),
        F.lit(50).cast("bigint").alias("target_stock"),
    )
    return {"branches": branches, "suppliers": suppliers, "products": products}


def sales(booked: DataFrame) -> DataFrame:
    return booked.where(F.col("flag") == "N").select(
        F.col("line_id").alias("sale_id"),
        *SERIES,
        _at(F.col("day"), 12).alias("sale_time"),
        _at_least_one(_whole(F.col("units"), 5)).alias("quantity"),
        (F.round(F.col("cents") / 5) * F.expr("0.01BD")).cast(MONEY).alias("revenue"),
    )


def supplier_orders(booked: DataFrame) -> DataFrame:
    order = F.col("line_id")
    exact = (order % NEVER_BOOKED == 0) | (order % BOOKED_TWICE == 0)
    ordered = F.when(exact, F.col("units")).otherwise(_at_least_one(_whole(F.col("units"), 4)))
    short = _whole(F.col("units") * F.col("discount"), 200)
    return booked.where(F.col("flag") == "A").select(
        order.alias("supplier_order_id"),
        *SERIES,
        "supplier_id",
        F.date_sub("day", (order % 5 + 1).cast("int")).alias("order_date"),
        F.date_sub("day", (order % 4 - 1).cast("int")).alias("expected_delivery_date"),
        F.col("day").alias("actual_delivery_date"),
        ordered.alias("ordered_quantity"),
        F.when(exact, F.col("units")).otherwise(_at_least_one(ordered - short)).alias("received_quantity"),
    )


def cancellations(booked: DataFrame) -> DataFrame:
    even = F.col("line_id") % 2 == 0
    return booked.where((F.col("flag") == "R") & (F.col("status") == "F")).select(
        F.col("line_id").alias("cancellation_id"),
        *SERIES,
        _at(F.col("day"), 18).alias("cancellation_time"),
        _at_least_one(_whole(F.col("units"), 10)).alias("requested_quantity"),
        F.when(even, L.OUT_OF_STOCK).otherwise(L.SYSTEM_SHOWED_AVAILABLE).alias("reason"),
    )


def _movement(number: Column, time: Column, kind: Column, quantity: Column, reference: Column) -> list[Column]:
    return [
        number.alias("movement_id"),
        *[F.col(name) for name in SERIES],
        time.alias("movement_time"),
        kind.alias("movement_type"),
        quantity.cast("bigint").alias("quantity"),
        reference.alias("reference_id"),
    ]


def _opening(booked: DataFrame) -> DataFrame:
    """Initial stock of each series on its first day."""
    first = booked.groupBy(*SERIES).agg(F.min("day").alias("day"))
    number = -(F.col("product_id") * 1000 + F.col("branch_id"))
    reference = F.concat_ws("-", F.lit("INIT"), F.col("branch_id").cast("string"), F.col("product_id").cast("string"))
    return first.select(
        _movement(number, _at(F.col("day"), 6), F.lit(L.INITIAL_STOCK), 10 + F.col("product_id") % 50, reference)
    )


def _sold(sold: DataFrame) -> DataFrame:
    number = F.col("sale_id")
    reference = F.concat(F.lit("SALE-"), number.cast("string"))
    return sold.select(_movement(number * 10, F.col("sale_time"), F.lit(L.SALE), F.col("quantity"), reference))


def _delivered(orders: DataFrame, copy: Column) -> DataFrame:
    number = F.col("supplier_order_id")
    reference = F.concat(F.lit("SUP-"), number.cast("string"))
    time = _at(F.col("actual_delivery_date"), 7)
    return orders.select(
        _movement(number * 10 + copy, time, F.lit(L.DELIVERY), F.col("received_quantity"), reference)
    )


def _corrected(booked: DataFrame) -> DataFrame:
    line = F.col("line_id")
    kind = (
        F.when(line % 3 == 0, L.WASTE).when(line % 3 == 1, L.POSITIVE_ADJUSTMENT).otherwise(L.NEGATIVE_ADJUSTMENT)
    )
    reference = F.when(line % 2 == 1, F.concat(F.lit("ADJ-"), line.cast("string")))
    quantity = _at_least_one(_whole(F.col("units"), 10))
    return booked.where((F.col("flag") == "R") & (F.col("status") == "O")).select(
        _movement(line * 10, _at(F.col("day"), 20), kind, quantity, reference)
    )


def true_movements(booked: DataFrame) -> DataFrame:
    """What really happened: every delivery once."""
    return (
        _opening(booked)
        .unionByName(_sold(sales(booked)))
        .unionByName(_delivered(supplier_orders(booked), F.lit(0)))
        .unionByName(_corrected(booked))
    )


def movements(booked: DataFrame) -> DataFrame:
    """What was booked: some deliveries never, some more than once."""
    order = F.col("supplier_order_id")
    entered = supplier_orders(booked).where(order % NEVER_BOOKED != 0)
    copies = F.when(order % BOOKED_THRICE == 0, 3).when(order % BOOKED_TWICE == 0, 2).otherwise(1)
    repeated = entered.withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    return (
        _opening(booked)
        .unionByName(_sold(sales(booked)))
        .unionByName(_delivered(repeated, F.col("copy")))
        .unionByName(_corrected(booked))
    )


def snapshots(booked: DataFrame, buckets: int | None = None) -> DataFrame:
    """Recorded closing stock: the running true stock less the running loss, never negative.

    A change of stock counts on its own day; it and a cancelled sale make their day and the
    next six counted days. Changes are summed by day and laid out by series, in ``buckets``
    parts if given, and sorted and added up there, before a day becomes up to seven: a change
    makes the days until the next one, so counted days are neither shuffled nor sorted nor summed.
    """
    moved, quantity = F.col("movement_type"), F.col("quantity")
    changes = (
        true_movements(booked)
        .select(*SERIES, X.day_of(F.col("movement_time")).alias("day"), X.signed_quantity(moved, quantity).alias("net"))
        .unionByName(
            cancellations(booked).select(
                *SERIES, X.day_of(F.col("cancellation_time")).alias("day"), X.zero().alias("net")
            )
        )
    )
    changed = by_series(daily(changes, F.col("day"), "day", F.sum("net").alias("net")), "day", "changed_on", buckets)
    in_order = Window.partitionBy(*SERIES).orderBy("changed_on")
    before = F.datediff("changed_on", F.lag("changed_on").over(in_order))
    after = F.datediff(F.lead("changed_on").over(in_order), "changed_on")
    first = F.datediff("changed_on", F.lit("1970-01-01").cast("date")).cast("bigint")
    cycle = 31 * F.col("branch_id") + 17 * F.col("product_id")
    # An unknown change is none where an earlier one still counts; else its day has no change at all, nor a loss.
    overlapped = F.col("changed_on").isNull() | (before < COUNTED_DAYS)
    runs = changed.select(
        *SERIES,
        "changed_on",
        F.when(overlapped, F.coalesce("net", X.zero())).otherwise(F.col("net")).alias("net"),
        # Changes without a day make one snapshot without a day.
        F.when(F.col("changed_on").isNull(), 1).otherwise(F.least(F.lit(COUNTED_DAYS), after)).alias("days"),
        F.pmod(-(cycle + first), F.lit(SHRINK_CYCLE)).alias("loses_after"),
    )
    lost = F.when((F.col("loses_after") == 0) & F.col("net").isNull(), 0).otherwise(SHRINK_UNITS)

    def loss_until(day: Column) -> Column:
        return F.when(F.col("loses_after") <= day, lost).otherwise(0)

    known = F.coalesce("net", X.zero())
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    so_far = X.or_zero(F.sum(known - loss_until(F.col("days") - 1)).over(earlier))
    counted = runs.withColumn("stock", so_far + known).withColumn("ahead", F.explode(F.sequence(F.lit(0), F.col("days") - 1)))
    day = F.date_add("changed_on", F.col("ahead"))
    number = F.datediff(day, F.lit("1970-01-01").cast("date")).cast("bigint")
    return counted.select(
        ((F.col("product_id") * 1000 + F.col("branch_id")) * 100000 + number).alias("snapshot_id"),
        *SERIES,
        day.alias("snapshot_date"),
        F.greatest(F.lit(0), F.col("stock") - loss_until(F.col("ahead"))).cast("bigint").alias("recorded_closing_stock"),
        ((cycle + number) % SHRINK_CYCLE == 0).alias("loses"),
    )


def known_issues(tables: dict[str, DataFrame], counted: DataFrame) -> DataFrame:
    """Labels of the mistakes built into the tables."""

    def label(issue_type: str, rows: DataFrame, day: Column) -> DataFrame:
        return rows.select(F.lit(issue_type).alias("issue_type"), *SERIES, day.alias("issue_date"))

    order = F.col("supplier_order_id")
    ordered, day = tables["supplier_orders"], F.col("actual_delivery_date")
    refused = tables["cancellations"].where(F.col("reason") == L.SYSTEM_SHOWED_AVAILABLE)
    return (
        label(
            L.DUPLICATE_MOVEMENT,
            ordered.where((order % BOOKED_TWICE == 0) & (order % NEVER_BOOKED != 0)),
            day,
        )
        .unionByName(label(L.MISSING_DELIVERY, ordered.where(order % NEVER_BOOKED == 0), day))
        .unionByName(label(L.SHRINKAGE, counted.where("loses"), F.col("snapshot_date")))
        .unionByName(label(L.PHANTOM, refused, F.col("cancellation_time").cast("date")))
    )


def stage(spark: SparkSession, folder: str, target: str) -> dict[str, DataFrame]:
    """Derive all tables from the star in ``folder`` and store them below ``target``.

    The snapshots, by far the largest table, lie in buckets by series.
    """
    booked = load_tables({"lines": lines(spark, folder)}, target)["lines"]
    # Counted from the footers of the files; a line makes seven snapshots at most.
    buckets = max(shuffle_parts(spark), -(-COUNTED_DAYS * booked.count() // BUCKET_ROWS))
    counted = store_snapshots(snapshots(booked, buckets), f"counted_{uuid.uuid4().hex}", buckets, path=f"{target}/counted.parquet")
    tables = dimensions(spark, folder) | {
        "sales": sales(booked),
        "supplier_orders": supplier_orders(booked),
        "movements": movements(booked),
        "cancellations": cancellations(booked),
    }
    stored = load_tables({name: df.select(*TABLES[name].names) for name, df in tables.items()}, target)
    stored["snapshots"] = counted.select(*TABLES["snapshots"].names)
    labels = known_issues(stored, counted).select(*KNOWN_ISSUES.names)
    return stored | load_tables({"known_issues": labels}, target)


_staged: dict[tuple, dict[str, DataFrame]] = {}


def source_key(spark: SparkSession, folder: str) -> tuple:
    """The application and the folder as its files are now; a changed file makes another key."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    listed = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    files = ((s.getPath().getName(), s.getModificationTime(), s.getLen()) for s in listed)
    return spark.sparkContext.applicationId, folder, tuple(sorted(files))


def inventory(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The eight tables and the labels, derived once per application and state of the source folder.

    They are stored as tables in the shared folder, so that queries start from them and
    survive the loss of executors.
    """
    key = source_key(spark, folder)
    if key not in _staged:
        tune(spark)
        _staged[key] = stage(spark, folder, new_folder(spark, "inventory"))
    return _staged[key]
