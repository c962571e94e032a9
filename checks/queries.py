"""The checked queries, one per operator, over tables derived from the given star schema."""

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from checks.broken import broken_tables
from checks.summaries import summaries
from stockrecon import labels as L
from stockrecon.functions import expressions as X
from stockrecon.operators import availability, copies, demand, integrity, ledger, performance, reconcile
from stockrecon.operators import reports as R
from stockrecon.operators.series import SERIES, by_series, join_bpd, left_join_zero, with_dims
from stockrecon.plans import analysis, dashboard, increments
from stockrecon.schemas import RESULTS
from stockrecon.session import new_folder
from checks import mart
from stockrecon.sources import exports, ranged, refresh, tables

Frames = Mapping[str, DataFrame]
Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_views: dict[tuple, dict[str, DataFrame]] = {}


def edge(df: DataFrame) -> DataFrame:
    """Decimals leave as doubles, the type other engines compare."""
    return df.select(
        *[
            F.col(field.name).cast("double").alias(field.name) if isinstance(field.dataType, T.DecimalType)
            else F.col(field.name)
            for field in df.schema
        ]
    )


def _analysis(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    key = mart.source_key(spark, folder)
    if key not in _views:
        _views[key] = analysis.views(mart.inventory(spark, folder))
    return _views[key]


def query(name: str):
    """Register ``build(t, v)`` over tables and views."""

    def add(build: Callable[[Frames, Frames], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return edge(build(mart.inventory(spark, folder), _analysis(spark, folder)))

        _QUERIES[name] = run
        return build

    return add


def source_query(name: str):
    """Register ``build(spark, folder, t, v)`` for queries that also write or read files."""

    def add(build: Callable[[SparkSession, str, Frames, Frames], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return edge(build(spark, folder, mart.inventory(spark, folder), _analysis(spark, folder)))

        _QUERIES[name] = run
        return build

    return add


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


BASE = ["branches", "suppliers", "products", "sales", "supplier_orders", "movements", "snapshots", "cancellations"]

# ---- sources and sinks --------------------------------------------------------------

#: Results that are read back by name for reports.
READ_RESULTS = (
    "reconciliation_issues",
    "phantom_inventory",
    "stockout_periods",
    "lost_sales_estimate",
    "supplier_performance",
    "branch_inventory_health",
)
#: Published extracts whose columns are those of another result.
PUBLISHED = {"phantom_inventory_examples": "phantom_inventory"}

#: Whole tables and results as text are several times their size as columns, so these are packed.
PACKED = "gzip"

_csv: dict[tuple, str] = {}


def _register_scan(name: str) -> None:
    @source_query(f"S1_scan_csv_{name}")
    def scan(spark, folder, t, v):
        key = (name, *mart.source_key(spark, folder))
        if key not in _csv:
            target = new_folder(spark, "csv")
            tables.load_tables({name: t[name]}, target, fmt="csv", compression=PACKED)
            _csv[key] = target
        return tables.read_table(spark, _csv[key], name, "csv")


for _name in BASE:
    _register_scan(_name)


@source_query("S2_scan_known_issues")
def _(spark, folder, t, v):
    path = exports.write(t["known_issues"], new_folder(spark, "labels"), "known_issues")
    return tables.read_known_issues(spark, path)


@source_query("S3_read_result")
def _(spark, folder, t, v):
    """The six results that reports read: written, then read by name."""
    target = new_folder(spark, "result")
    for name in READ_RESULTS:
        exports.write(v[name], target, name, "parquet")
    return summaries({name: tables.read_result(spark, target, name) for name in READ_RESULTS})


@source_query("S5_load_tables")
def _(spark, folder, t, v):
    """All eight tables stored as columns and as text, and scanned back."""
    target = new_folder(spark, "load")
    base = {name: t[name] for name in BASE}
    columns = tables.load_tables(base, target)
    text = tables.load_tables(base, target, fmt="csv", compression=PACKED)
    return summaries(columns | {f"{name} (csv)": df for name, df in text.items()})


@source_query("S5_refresh_that_breaks_off")
def _(spark, folder, t, v):
    """All tables are refreshed together; a second refresh breaks off in its last table."""
    target = new_folder(spark, "refresh")
    base = {name: t[name] for name in BASE}
    refresh.refresh_tables(spark, base, target)
    broken = F.raise_error(F.lit("source broke off")).cast("bigint")
    half = {name: df.limit(1) for name, df in base.items()}
    half["cancellations"] = base["cancellations"].withColumn("requested_quantity", broken)
    try:
        refresh.refresh_tables(spark, half, target)
    except Exception as error:  # the refresh is meant to fail, in this way only
        if "source broke off" not in str(error):
            raise
    return summaries(refresh.current(spark, target))


@source_query("S6_register_views")
def _(spark, folder, t, v):
    analysis.register(spark, {name: t[name] for name in BASE})
    return spark.sql(
        """
        SELECT b.region, i.category, count(*) AS issue_count, sum(abs(i.stock_difference)) AS units_affected
        FROM vw_reconciliation_issues i JOIN branches b ON b.branch_id = i.branch_id
        GROUP BY b.region, i.category
        """
    )


@source_query("S7_export_all")
def _(spark, folder, t, v):
    target = new_folder(spark, "export")
    stored = analysis.stored_views(t, new_folder(spark, "views"))
    written = exports.export_all(stored, target, compression=PACKED)
    return summaries({name: tables.read_result(spark, target, name, "csv") for name in written})


@source_query("S8_export_published")
def _(spark, folder, t, v):
    target = new_folder(spark, "published")
    written = exports.export_published(v, analysis.validation(t, v), target)
    schemas = {name: RESULTS[PUBLISHED.get(name, name)] for name in written}
    return summaries({name: tables.read_file(spark, path, schemas[name], "csv") for name, path in written.items()})


@source_query("S9_write_validation")
def _(spark, folder, t, v):
    target = new_folder(spark, "validation")
    exports.write(analysis.validation(t, v), target, "validation_summary")
    return tables.read_result(spark, target, "validation_summary", "csv")


@query("S10_row_counts")
def _(t, v):
    return tables.row_counts({name: t[name] for name in BASE})


@source_query("S10_rows_counted_while_written")
def _(spark, folder, t, v):
    target = new_folder(spark, "counted")
    refresh.refresh_tables(spark, {name: t[name] for name in BASE}, target)
    return refresh.row_counts(spark, target)


# ---- integrity ----------------------------------------------------------------------

for _family in ("Q1", "Q2", "Q3", "Q4", "Q5", "Q6", "Q7"):
    _QUERIES[f"{_family}_model_rules"] = lambda spark, folder, family=_family: integrity.violations(
        broken_tables(mart.inventory(spark, folder)), family
    )


@query("O12_first_offenders")
def _(t, v):
    return integrity.first_offenders(integrity.violations(broken_tables(t), "Q5", "Q7"))


@source_query("Q1_repeated_line_keys")
def _(spark, folder, t, v):
    return integrity.pk_violations(mart.star(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], "lineitem")


@query("Q2_repeated_delivery_days")
def _(t, v):
    return integrity.unique_violations(
        t["supplier_orders"], [*SERIES, "actual_delivery_date"], "supplier_orders"
    )


@query("Q3_missing_references")
def _(t, v):
    return integrity.null_violations(t["movements"], ["reference_id", "movement_type"], "movement_id", "movements")


@query("Q4_unlisted_types")
def _(t, v):
    listed = "movement_type IN ('INITIAL_STOCK', 'DELIVERY', 'SALE', 'POSITIVE_ADJUSTMENT')"
    return integrity.check_violations(t["movements"], listed, "movement_id", "movements", "Q4")


@query("Q5_out_of_range_sales")
def _(t, v):
    return integrity.check_violations(t["sales"], ["quantity >= 2", "revenue <= 15000"], "sale_id", "sales")


@query("Q6_expected_before_order")
def _(t, v):
    check = "expected_delivery_date >= order_date"
    return integrity.check_violations(t["supplier_orders"], check, "supplier_order_id", "supplier_orders", "Q6")


@query("Q7_suppliers_without_product")
def _(t, v):
    return integrity.fk_violations(
        t["supplier_orders"], "supplier_id", t["products"], "supplier_id", "supplier_order_id",
        "supplier_orders", "products",
    )


# ---- expressions and filters --------------------------------------------------------


@query("P18_filter_options")
def _(t, v):
    return R.filter_options(v["reconciliation_issues"], "issue_severity")


@query("P8_filter_in")
def _(t, v):
    return R.filter_in(v["reconciliation_issues"], "issue_severity", ["Critical", "High"]).select(
        "snapshot_id", "issue_severity", "probable_issue"
    )


@query("P11_signed_quantity")
def _(t, v):
    kind, quantity = F.col("movement_type"), F.col("quantity")
    return t["movements"].select(
        "movement_id",
        X.inflow_quantity(kind, quantity).alias("inflow"),
        X.outflow_quantity(kind, quantity).alias("outflow"),
        X.signed_quantity(kind, quantity).alias("net"),
    )


@query("X_order_expressions")
def _(t, v):
    order, expected, actual = (
        F.col(c) for c in ("supplier_order_id", "expected_delivery_date", "actual_delivery_date")
    )
    return t["supplier_orders"].select(
        order.alias("supplier_order_id"),
        X.supplier_reference(order).alias("reference"),
        X.shift_days(actual, -7).alias("week_before"),
        X.island_id(actual, order % 100).alias("island"),
        X.delay_days(actual, expected).cast("bigint").alias("delay"),
        X.is_late(actual, expected).cast("int").cast("bigint").alias("late"),
        X.is_on_time(actual, expected).cast("int").cast("bigint").alias("on_time"),
        X.round2(X.pct(F.col("received_quantity"), F.col("ordered_quantity"))).alias("fill"),
        X.round2_half_even(F.col("received_quantity") * F.expr("0.125BD")).alias("eighths"),
    )


# ---- joins --------------------------------------------------------------------------


@query("J1_with_dims")
def _(t, v):
    return with_dims(t["sales"], t["branches"], t["products"])


@query("J2_join_bpd")
def _(t, v):
    refused = ledger.cancelled_by_day(t["cancellations"]).withColumnRenamed("cancellation_date", "snapshot_date")
    return join_bpd(t["snapshots"], refused, "snapshot_date")


@query("J3_left_join_zero")
def _(t, v):
    sold = by_series(v["daily_sales"].select(*SERIES, "sale_date", "units_sold"), "sale_date", "snapshot_date")
    return left_join_zero(t["snapshots"], sold, "snapshot_date", ["units_sold"])


@query("J4_assemble_branch")
def _(t, v):
    return performance.assemble_branch(
        t["branches"], v["inventory_reconciliation"], v["phantom_inventory"], v["lost_sales_estimate"]
    )


@query("J5_expected_units")
def _(t, v):
    days = v["stockout_days"].select(*SERIES, "stockout_date")
    return demand.expected_units(days, v["daily_sales"])


@query("J7_orders_without_movement")
def _(t, v):
    return v["orders_without_movement"]


@query("J8_flag_matches")
def _(t, v):
    detected = R.detected_issues(
        v["phantom_inventory"], v["duplicate_days"], v["orders_without_movement"], v["reconciliation_issues"]
    )
    return R.flag_matches(t["known_issues"], detected, ["issue_type", *SERIES, "issue_date"]).withColumn(
        "detected", F.col("detected").cast("bigint")
    )


@query("J9_one_row")
def _(t, v):
    return R.one_row(
        units_sold=(t["sales"], F.sum("quantity")),
        revenue=(t["sales"], F.sum("revenue")),
        last_snapshot=(t["snapshots"], F.max("snapshot_date")),
        suppliers=(t["suppliers"], F.count(F.lit(1))),
    )


# ---- aggregations -------------------------------------------------------------------


@query("A3_duplicate_days")
def _(t, v):
    return v["duplicate_days"]


@query("A4_delivery_days")
def _(t, v):
    return ledger.delivery_days(t["supplier_orders"])


@query("A5_cancelled_by_day_shown")
def _(t, v):
    return ledger.cancelled_by_day(t["cancellations"], L.SYSTEM_SHOWED_AVAILABLE)


@query("A6_cancelled_by_day")
def _(t, v):
    return ledger.cancelled_by_day(t["cancellations"])


@query("A10_branch_reconciliation")
def _(t, v):
    return performance.branch_reconciliation(v["inventory_reconciliation"])


@query("A11_branch_phantom")
def _(t, v):
    return performance.branch_phantom(v["phantom_inventory"])


@query("A12_branch_lost")
def _(t, v):
    return performance.branch_lost(v["lost_sales_estimate"])


# ---- windows and sets ---------------------------------------------------------------


@query("W1_previous_stock")
def _(t, v):
    return reconcile.previous_stock(t["snapshots"])


@query("W2_number_duplicates")
def _(t, v):
    return copies.number_duplicates(t["movements"])


@query("W3_number_days")
def _(t, v):
    return availability.number_days(v["stockout_days"].select(*SERIES, "stockout_date"))


@query("W4_risk_rank")
def _(t, v):
    money = F.col("estimated_lost_revenue")
    ranked = v["branch_inventory_health"].drop("risk_rank").withColumn(
        "estimated_lost_revenue", (F.floor(money / 100000) * 100000).cast("decimal(28,2)")
    )
    return R.select_present(performance.risk_rank(ranked), ["branch_id", "estimated_lost_revenue", "risk_rank"])


@query("U2_demand_by_day")
def _(t, v):
    return demand.demand_by_day(v["daily_sales"])


@query("U3_union_distinct")
def _(t, v):
    return R.detected_issues(
        v["phantom_inventory"], v["duplicate_days"], v["orders_without_movement"], v["reconciliation_issues"]
    )


# ---- views --------------------------------------------------------------------------

def _register_view(number: int, name: str) -> None:
    @query(f"V{number}_{name}")
    def view(t, v):
        return v[name]


for _number, _name in enumerate(analysis.VIEWS, 1):
    _register_view(_number, _name)


#: Views over two loads, the second of which reads the later days and the carried state.
IN_TWO_LOADS = {
    "inventory_reconciliation": "V4_in_two_loads",
    "reconciliation_issues": "V5_in_two_loads",
    "phantom_inventory": "V6_in_two_loads",
    "stockout_days": "V7_in_two_loads",
    "stockout_periods": "V8_in_two_loads",
    "lost_sales_estimate": "V9_in_two_loads",
    "branch_inventory_health": "V11_in_two_loads",
}
_loads: dict[tuple, str] = {}


def _in_two_loads(spark: SparkSession, folder: str, t: Frames) -> str:
    """Folder of two loads, cut in the middle of the snapshots."""
    key = mart.source_key(spark, folder)
    if key not in _loads:
        low, high = t["snapshots"].agg(F.min("snapshot_date"), F.max("snapshot_date")).first()
        days = [t[name].agg(F.max(F.col(day).cast("date"))).first()[0] for name, day in increments.DAYS.items()]
        target = new_folder(spark, "loads")
        increments.advance(spark, t, target, low + (high - low) // 2)
        increments.advance(spark, t, target, max(day for day in days if day is not None))
        _loads[key] = target
    return _loads[key]


def _register_loads(name: str, entry: str) -> None:
    @source_query(entry)
    def view(spark, folder, t, v):
        return increments.views(spark, t, _in_two_loads(spark, folder, t))[name]


for _name, _entry in IN_TWO_LOADS.items():
    _register_loads(_name, _entry)


# ---- reports ------------------------------------------------------------------------


@query("R1_issue_mix")
def _(t, v):
    return R.issue_mix(v["reconciliation_issues"])


@query("R2_phantom_by_value")
def _(t, v):
    return R.phantom_by_value(v["phantom_inventory"])


@query("R3_longest_stockouts")
def _(t, v):
    return R.longest_stockouts(v["stockout_periods"])


@query("R4_supplier_league")
def _(t, v):
    return R.supplier_league(v["supplier_performance"])


@query("R5_branch_ranking")
def _(t, v):
    return R.branch_ranking(v["branch_inventory_health"])


@query("R6_validation_summary")
def _(t, v):
    return analysis.validation(t, v)


@query("R7_top_branches")
def _(t, v):
    return R.top_branches(v["branch_inventory_health"], 10).select("branch_name", "estimated_lost_revenue")


@query("R8_supplier_on_time")
def _(t, v):
    return R.supplier_on_time(v["supplier_performance"])


@query("R9_cause_counts")
def _(t, v):
    return R.cause_counts(v["reconciliation_issues"])


@query("R10_category_lost_revenue")
def _(t, v):
    return R.category_lost_revenue(v["lost_sales_estimate"])


@query("R11_executive_kpis")
def _(t, v):
    return R.executive_kpis(
        t["snapshots"], v["reconciliation_issues"], v["phantom_inventory"], v["duplicate_days"], v["lost_sales_estimate"]
    )


@query("R12_dashboard_kpis")
def _(t, v):
    return R.dashboard_kpis(
        v["reconciliation_issues"], v["phantom_inventory"], v["lost_sales_estimate"], analysis.validation(t, v),
        v["supplier_performance"], ["Critical", "High"],
    )


@query("R13_branch_filter")
def _(t, v):
    return R.filter_in(v["branch_inventory_health"], "branch_name", ["NATION_1", "NATION_7", "NATION_20"])


@query("R14_severity_mix")
def _(t, v):
    return R.severity_mix(R.filter_in(v["reconciliation_issues"], "issue_severity", ["Critical", "High", "Medium"]))


@query("R15_top_phantom")
def _(t, v):
    return R.top_phantom(v["phantom_inventory"], 100)


@query("R15_top_differences")
def _(t, v):
    return R.top_differences(v["reconciliation_issues"], 100)


@query("R16_supplier_fill")
def _(t, v):
    return R.supplier_fill(v["supplier_performance"])


@query("R17_branch_risk_table")
def _(t, v):
    return R.branch_risk_table(v["branch_inventory_health"])


@query("O1_largest_differences")
def _(t, v):
    return R.largest_differences(v["reconciliation_issues"])


@query("O4_lost_by_value")
def _(t, v):
    return R.lost_by_value(v["lost_sales_estimate"])


@query("O11_order_for_chart")
def _(t, v):
    return R.order_for_chart(R.cause_counts(v["reconciliation_issues"]), "issue_count", False, "probable_issue")


@query("O8_top_12_branches")
def _(t, v):
    return R.top_branches(v["branch_inventory_health"], 12)


@query("O9_top_20_phantom")
def _(t, v):
    return R.top_phantom(v["phantom_inventory"], 20)


#: Rows of an ordered result whose positions are compared.
FIRST = 25


def _positions(name: str, view: str, order: Callable[[DataFrame], DataFrame], *columns: str) -> None:
    @query(name)
    def positions(t, v):
        first = order(v[view]).limit(FIRST)
        # The limited rows are one partition in their order.
        place = F.row_number().over(Window.orderBy(F.monotonically_increasing_id()))
        return first.select(place.cast("bigint").alias("position"), *columns)


_positions("O1_positions", "reconciliation_issues", R.largest_differences, *SERIES, "snapshot_date")
_positions("O2_positions", "phantom_inventory", R.phantom_by_value, *SERIES, "snapshot_date")
_positions("O3_positions", "stockout_periods", R.longest_stockouts, *SERIES, "stockout_start")
_positions("O4_positions", "lost_sales_estimate", R.lost_by_value, *SERIES, "stockout_date")
_positions("O5_positions", "supplier_performance", R.supplier_league, "supplier_id")
_positions("O6_positions", "branch_inventory_health", R.branch_ranking, "branch_id")
_positions(
    "O11_positions",
    "reconciliation_issues",
    lambda issues: R.order_for_chart(R.cause_counts(issues), "issue_count", True, "probable_issue"),
    "probable_issue",
)


# ---- stored for readers -------------------------------------------------------------

#: Columns of the issues that a dashboard is made from.
DASHBOARD_ISSUES = (*SERIES, "snapshot_date", "branch_name", "stock_difference", "issue_severity", "probable_issue")
_dashboards: dict[tuple, str] = {}


def _dashboard(spark: SparkSession, folder: str, t: Frames, v: Frames) -> dict[str, DataFrame]:
    """What a dashboard shows, stored once and read again."""
    key = mart.source_key(spark, folder)
    if key not in _dashboards:
        target = new_folder(spark, "dashboard")
        # The summary and the validation both read the issues, and no more of them than this.
        issues = v["reconciliation_issues"].select(*DASHBOARD_ISSUES)
        shared = dict(v) | tables.load_tables({"reconciliation_issues": issues}, new_folder(spark, "shared"))
        dashboard.store(spark, shared, analysis.validation(t, shared), target)
        _dashboards[key] = target
    return dashboard.read(spark, _dashboards[key])


def _register_stored(name: str, build: Callable[[Frames], DataFrame]) -> None:
    @source_query(name)
    def stored(spark, folder, t, v):
        return build(_dashboard(spark, folder, t, v))


_register_stored("R1_from_stored", dashboard.issue_mix)
_register_stored("R9_from_stored", dashboard.cause_counts)
_register_stored("R12_from_stored", lambda stored: dashboard.kpis(stored, ["Critical", "High"]))
_register_stored("R13_mix_of_branches", lambda stored: dashboard.issue_mix(stored, branch_name=["NATION_1", "NATION_7", "NATION_20"]))
_register_stored("R14_from_stored", lambda stored: dashboard.severity_mix(stored, issue_severity=["Critical", "High", "Medium"]))
_register_stored("R17_from_stored", dashboard.branch_risk)

#: The part of an order that is read from a stored result.
PAGE = (100, 160)


def _register_page(name: str, view: str, *columns: str) -> None:
    @source_query(name)
    def page(spark, folder, t, v):
        path = f"{new_folder(spark, 'ordered')}/{view}.parquet"
        ranged.write_ordered(v[view], exports.ORDERS[view], path, 500)
        return ranged.read_positions(spark, path, v[view].schema, *PAGE).select("position", *columns)


_register_page("O1_page", "reconciliation_issues", *SERIES, "snapshot_date")
_register_page("O2_page", "phantom_inventory", *SERIES, "snapshot_date")
_register_page("O3_page", "stockout_periods", *SERIES, "stockout_start")
_register_page("O4_page", "lost_sales_estimate", *SERIES, "stockout_date")
