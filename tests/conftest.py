import os
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from stockrecon.session import tune  # noqa: E402

STAR = os.environ.get("STAR_DIR", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "4")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="warehouse-"))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture(scope="session")
def inventory(spark):
    """Derived tables of the smallest star."""
    from checks import mart

    return mart.inventory(spark, f"{STAR}/sf0.001")


@pytest.fixture(scope="session")
def all_views(inventory):
    from stockrecon.plans import analysis

    return analysis.views(inventory)
