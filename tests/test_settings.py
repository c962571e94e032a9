"""Results do not depend on the settings the plans are tuned for."""

import pytest

from stockrecon.plans import analysis
from stockrecon.session import tune

UNTUNED = {
    "adaptive off, plain layouts": {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.requireAllClusterKeysForCoPartition": "true",
    },
    "no broadcast": {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    },
    "skew splitting forced": {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    },
}
NAMES = ["reconciliation_issues", "stockout_periods", "lost_sales_estimate", "branch_inventory_health", "data_quality_issues"]


def rows(views):
    return {name: sorted(map(str, views[name].collect())) for name in NAMES}


@pytest.fixture(scope="module")
def expected(all_views):
    return rows(all_views)


@pytest.mark.parametrize("case", list(UNTUNED))
def test_same_rows(spark, inventory, expected, case):
    for key, value in UNTUNED[case].items():
        spark.conf.set(key, value)
    try:
        found = rows(analysis.views(inventory))
    finally:
        for key in UNTUNED[case]:
            spark.conf.unset(key)
        tune(spark)
    assert found == expected
