"""The data sets behind a dashboard, stored once so that a choice of filters recomputes nothing."""

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockrecon.operators import choices, reports
from stockrecon.sources import refresh

_OWN = ("issue_summary", "key_figures")
_VIEWS = ("branch_inventory_health", "supplier_performance")


def store(spark: SparkSession, v: Mapping[str, DataFrame], validation: DataFrame, target: str) -> int:
    """Store what the dashboard shows; all of it appears together. Returns the version.

    ``key_figures`` are those that follow no choice. They are taken from what is stored beside them, so
    no view is computed again for them. Views that other results share should be stored ones.
    """
    load = refresh.Load(spark, target)
    summary = load.write("issue_summary", choices.issue_summary(v["reconciliation_issues"]).coalesce(1))
    health, performance = (load.write(name, v[name]) for name in _VIEWS)
    load.write("key_figures", reports.stored_kpis(choices.choose(summary), health, validation, performance))
    return load.commit()


def read(spark: SparkSession, target: str) -> dict[str, DataFrame]:
    stored = refresh.current(spark, target)
    return {name: stored[name] for name in (*_OWN, *_VIEWS)}


def kpis(stored: Mapping[str, DataFrame], severities: list[str] | None = None) -> DataFrame:
    """The key figures; the issue count follows the choice."""
    figures = stored["key_figures"].drop("issue_count")
    counted = choices.choose(stored["issue_summary"], issue_severity=severities)
    scalars = {name: (figures, F.max(name)) for name in figures.columns}
    return reports.one_row(issue_count=(counted, F.max("issue_count")), **scalars)


def severity_mix(stored: Mapping[str, DataFrame], **chosen: list[str] | None) -> DataFrame:
    counts = choices.choose(stored["issue_summary"], ["issue_severity"], **chosen)
    return counts.select("issue_severity", "issue_count").orderBy(F.desc("issue_count"), "issue_severity")


def cause_counts(stored: Mapping[str, DataFrame], **chosen: list[str] | None) -> DataFrame:
    counts = choices.choose(stored["issue_summary"], ["probable_issue"], **chosen)
    return counts.select("probable_issue", "issue_count").orderBy(F.desc("issue_count"), "probable_issue")


def issue_mix(stored: Mapping[str, DataFrame], **chosen: list[str] | None) -> DataFrame:
    mix = choices.choose(stored["issue_summary"], ["probable_issue", "issue_severity"], **chosen)
    return mix.orderBy(F.desc("issue_count"), "probable_issue", "issue_severity")


def branch_risk(stored: Mapping[str, DataFrame], branches: list[str] | None = None) -> DataFrame:
    return reports.branch_risk_table(stored["branch_inventory_health"], branches)
