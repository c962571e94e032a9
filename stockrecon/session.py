"""Session settings the plans are written for, and the shared scratch folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings, safe to change on a running session.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join on (branch, product, day) may use a partitioning by (branch, product), so that
    # windows, joins and groupings over one series share a single shuffle.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Sizes of Parquet files understate rows in memory; judge broadcasts by the larger figure.
    "spark.sql.sources.fileCompressionFactor": "3.0",
    # A dimension found to be smaller than this at run time is broadcast before the snapshots
    # would be shuffled for it.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # Shuffled rows of small numbers grow some thirtyfold in sorts and groupings, more where days
    # are carried forward; parts of this size keep a task well below its share of an executor.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # Snapshots stored in one file per bucket are known to lie in the order they were written in,
    # so windows and joins on a series and its days need not sort them. With more files Spark sorts.
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings; start shuffles wide on a large cluster and let AQE merge them."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    wide = 3 * spark.sparkContext.defaultParallelism
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if spark.conf.get(key, None) is None and wide > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(key, str(wide))
    return spark


def shuffle_parts(spark: SparkSession) -> int:
    """Parts a shuffle starts with. A table in as many buckets, or more, keeps its layout in joins."""
    parts = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return int(parts or spark.conf.get("spark.sql.shuffle.partitions"))


def build_session(app: str = "stockrecon", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, for tables that cut a lineage.

    It is the one named by ``spark.checkpoint.dir``. Only a local session without that
    setting gets a temporary folder of its own; a cluster must name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="stockrecon-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is overwritten."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
