"""Writing result sets."""

from collections.abc import Mapping

from pyspark.sql import DataFrame

from stockrecon.operators import reports as R
from stockrecon.sources.tables import write_file


def write(df: DataFrame, folder: str, name: str, fmt: str = "csv", compression: str | None = None) -> str:
    """Write one result to ``<folder>/<name>.<fmt>``, replacing an older one."""
    path = f"{folder.rstrip('/')}/{name}.{fmt}"
    write_file(df, path, fmt, compression=compression)
    return path


#: The eight exported result sets and their reading orders.
ORDERS = {
    "inventory_reconciliation": lambda df: df,
    "reconciliation_issues": R.largest_differences,
    "phantom_inventory": R.phantom_by_value,
    "stockout_periods": R.longest_stockouts,
    "lost_sales_estimate": R.lost_by_value,
    "supplier_performance": R.supplier_league,
    "branch_inventory_health": R.branch_ranking,
    "data_quality_issues": lambda df: df,
}


def ordered_exports(views: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The eight exported result sets, each in its reading order."""
    return {name: order(views[name]) for name, order in ORDERS.items()}


def published_extracts(views: Mapping[str, DataFrame], validation: DataFrame) -> dict[str, DataFrame]:
    """The four short extracts: 12 riskiest branches, suppliers, 20 phantom cases, recall."""
    return {
        "branch_inventory_health": R.top_branches(views["branch_inventory_health"], 12),
        "supplier_performance": R.supplier_league(views["supplier_performance"]),
        "phantom_inventory_examples": R.top_phantom(views["phantom_inventory"], 20),
        "validation_summary": validation,
    }


def export_all(
    views: Mapping[str, DataFrame], folder: str, fmt: str = "csv", compression: str | None = None
) -> dict[str, str]:
    return {name: write(df, folder, name, fmt, compression) for name, df in ordered_exports(views).items()}


def export_published(
    views: Mapping[str, DataFrame], validation: DataFrame, folder: str, fmt: str = "csv"
) -> dict[str, str]:
    return {name: write(df, folder, name, fmt) for name, df in published_extracts(views, validation).items()}
