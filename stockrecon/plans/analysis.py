"""How the views depend on tables and on each other."""

import uuid
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from stockrecon.operators import availability, copies, demand, integrity, ledger, performance, reconcile, reports
from stockrecon.schemas import TABLES
from stockrecon.sources import exports
from stockrecon.sources.refresh import write_counted
from stockrecon.sources.tables import (
    bucket_count,
    load_tables,
    read_file,
    read_known_issues,
    read_tables,
    register_views,
    row_counts,
    store_snapshots,
    unreadable,
)
from stockrecon.session import new_folder

Keep = Callable[[str, DataFrame], DataFrame]


def views(
    t: Mapping[str, DataFrame], keep: Keep = lambda name, df: df, touched: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The twelve views over the eight tables, and two lists several of them read.

    ``keep`` may store a frame that others read or that is exported, so that it is computed
    once. Without it every view is one lazy plan over the tables. ``touched`` may give
    ``availability.touched`` of the snapshots if it is stored.
    """
    dims = (t["branches"], t["products"])
    touched = t["snapshots"] if touched is None else touched
    v: dict[str, DataFrame] = {}

    def add(name: str, df: DataFrame, shared: bool = True) -> None:
        v[name] = keep(name, df) if shared else df

    add("daily_sales", ledger.daily_sales(t["sales"]), shared=False)
    add("daily_movements", ledger.daily_movements(t["movements"]), shared=False)
    groups = keep("copy_groups", copies.copy_groups(t["movements"]))
    add("duplicate_movements", copies.duplicate_movements(t["movements"], groups=groups), shared=False)
    add("duplicate_days", copies.duplicate_days(t["movements"], groups))
    add("orders_without_movement", integrity.orders_without_movement(t["supplier_orders"], t["movements"]))
    add(
        "inventory_reconciliation",
        reconcile.inventory_reconciliation(t["snapshots"], *dims, v["daily_movements"]),
    )
    add(
        "reconciliation_issues",
        reconcile.reconciliation_issues(v["inventory_reconciliation"], v["duplicate_days"], t["supplier_orders"]),
    )
    add("phantom_inventory", availability.phantom_inventory(touched, t["cancellations"], *dims))
    add("stockout_days", availability.stockout_days(touched, t["cancellations"], *dims))
    add("stockout_periods", availability.stockout_periods(v["stockout_days"]))
    add(
        "lost_sales_estimate",
        demand.lost_sales_estimate(v["stockout_days"], v["daily_sales"], t["products"]),
    )
    add("supplier_performance", performance.supplier_performance(t["supplier_orders"], t["suppliers"]))
    add(
        "branch_inventory_health",
        performance.branch_inventory_health(
            t["branches"], v["inventory_reconciliation"], v["phantom_inventory"], v["lost_sales_estimate"]
        ),
    )
    add(
        "data_quality_issues",
        integrity.data_quality_issues(v["duplicate_movements"], v["orders_without_movement"]),
    )
    return v


def stored_views(t: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """The views, with those that others read or that are sorted for an export stored below ``folder``.

    Each of these is computed once. The reconciliation is not stored: its rows are all snapshots with
    names, and computing it again from snapshots in buckets takes less than writing and reading them.
    """

    def store(name: str, df: DataFrame) -> DataFrame:
        return df if name == "inventory_reconciliation" else load_tables({name: df}, folder)[name]

    touched = store("touched", availability.touched(t["snapshots"], t["cancellations"]))
    return views(t, store, touched)


def validation(t: Mapping[str, DataFrame], v: Mapping[str, DataFrame]) -> DataFrame:
    return reports.validation_summary(
        t["known_issues"],
        v["phantom_inventory"],
        v["duplicate_days"],
        v["orders_without_movement"],
        v["reconciliation_issues"],
    )


VIEWS = (
    "daily_sales",
    "daily_movements",
    "duplicate_movements",
    "inventory_reconciliation",
    "reconciliation_issues",
    "phantom_inventory",
    "stockout_days",
    "stockout_periods",
    "lost_sales_estimate",
    "supplier_performance",
    "branch_inventory_health",
    "data_quality_issues",
)


def register(spark: SparkSession, t: Mapping[str, DataFrame]) -> list[str]:
    """Register the tables by name and the views with the prefix ``vw_`` for ``spark.sql``."""
    v = views(t)
    return register_views(spark, t) + register_views(spark, {name: v[name] for name in VIEWS}, "vw_")


def run(
    spark: SparkSession,
    source: str,
    target: str,
    source_fmt: str = "csv",
    target_fmt: str = "csv",
    known_issues: str | None = None,
    strict: bool = True,
) -> DataFrame:
    """Load, check, analyse and export; returns the row counts of loaded tables and exported sets.

    Every rule of the model is checked before any view is computed, and what breaks one is
    written as ``integrity_violations``, unreadable fields of text files included. If there are
    such rows the run ends there, unless ``strict`` is off. Snapshots are laid out by series
    once, as a table in buckets that all views read without a shuffle; groups of equal movements
    are counted once. Shared views are stored once in the shared folder and read from there;
    those that are exported as Parquet are stored where they are exported, in their order. Rows
    are counted while they are written.
    """
    work, target = new_folder(spark, "run"), target.rstrip("/")
    counts: dict[str, int] = {}

    def store(name: str, df: DataFrame) -> DataFrame:
        path = f"{work}/{name}.parquet"
        ordered = df
        if target_fmt == "parquet" and name in exports.ORDERS:
            path, ordered = f"{target}/{name}.parquet", exports.ORDERS[name](df)
        counts[name] = write_counted(ordered, path, "parquet")
        return read_file(spark, path, df.schema, "parquet")

    t = read_tables(spark, source, source_fmt)
    found = []
    if source_fmt == "csv":
        t = {name: store(name, df) for name, df in t.items()}
        found = [unreadable(spark, source, name) for name in t]
    broken = reduce(DataFrame.unionByName, found, integrity.violations(t))
    broken = load_tables({"integrity_violations": broken}, work)["integrity_violations"]
    exports.write(broken, target, "integrity_violations", target_fmt)
    if strict:
        integrity.refuse(broken)
    laid_out = f"snapshots_{uuid.uuid4().hex}"
    try:
        stored = store_snapshots(t["snapshots"], laid_out, bucket_count(t["snapshots"]))
        v = views(t | {"snapshots": stored}, store)
        if target_fmt != "parquet":
            exports.export_all(v, target, target_fmt)
        if known_issues:
            t["known_issues"] = read_known_issues(spark, known_issues, source_fmt)
            summary = load_tables({"validation_summary": validation(t, v)}, work)["validation_summary"]
            exports.write(summary, target, "validation_summary", target_fmt)
            exports.export_published(v, summary, f"{target}/published", target_fmt)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {laid_out}")  # every exported view is stored by now
    unread = {name: t[name] for name in TABLES if name not in counts}
    listed = spark.createDataFrame([(n, counts[n]) for n in (*TABLES, *exports.ORDERS) if n in counts], "name string, rows bigint")
    return row_counts(unread).unionByName(listed) if unread else listed
