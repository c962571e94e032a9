"""Results stored in an order that readers need not sort for again.

Writing sorts once, by ranges that Spark samples, so each file holds a run of the order. A small
table beside the files, the order's manifest, says at which position each file begins. A row's
position is that plus its place in the file, so any part of the order is read from the few files
that hold it: the first rows of a result, or a page of a long ranking.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: Rows of a file, at most.
FILE_ROWS = 1_000_000
_MANIFEST = "file string, start bigint, rows bigint"


def _manifest_path(path: str) -> str:
    return f"{path.rstrip('/')}.order"


def write_ordered(df: DataFrame, order: Callable[[DataFrame], DataFrame], path: str, file_rows: int = FILE_ROWS) -> int:
    """Store ``order(df)`` as Parquet, replacing an older one, and return its number of rows.

    The order should be total, or rows that tie are stored in any order. The manifest is written
    last and names files of this write only, so readers of a write that broke off fail instead of
    getting rows of two writes.
    """
    order(df).write.mode("overwrite").option("maxRecordsPerFile", file_rows).parquet(path)
    spark = df.sparkSession
    # Needs no column, so rows are counted from the footers of the files.
    stored = spark.read.schema(df.schema).parquet(path).groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    # part-<range>-<write>-c<file of the range>: compared as numbers, one row per file.
    parts = [F.regexp_extract("file", pattern, 1).cast("bigint") for pattern in (r"^part-(\d+)", r"-c(\d+)\.")]
    before = Window.orderBy(*parts).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("rows").over(before), F.lit(0).cast("bigint"))
    manifest = stored.select("file", start.alias("start"), "rows")
    manifest.coalesce(1).write.mode("overwrite").parquet(_manifest_path(path))
    return _manifest(spark, path).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_MANIFEST).parquet(_manifest_path(path))


def read_positions(spark: SparkSession, path: str, schema: T.StructType, start: int = 0, stop: int | None = None) -> DataFrame:
    """The rows at the positions from ``start`` up to ``stop``, counted from 0, with ``position``.

    Only files that hold such rows are opened. Rows are not sorted here; sort the ones wanted by
    ``position``. ``schema`` has no column of that name.
    """
    files = _manifest(spark, path).where(F.col("start") + F.col("rows") > start)
    if stop is not None:
        files = files.where(F.col("start") < stop)
    begins = {f"{path.rstrip('/')}/{row['file']}": row["start"] for row in files.collect()}
    if not begins:
        return spark.createDataFrame([], T.StructType([*schema, T.StructField("position", T.LongType())]))
    listed = spark.createDataFrame([(name.rsplit("/", 1)[1], begin) for name, begin in begins.items()], "_file string, _start bigint")
    rows = spark.read.schema(schema).parquet(*begins)
    # The list is one row per file that is read, so no larger than their listing.
    placed = rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")).join(F.broadcast(listed), "_file")
    placed = placed.withColumn("position", F.col("_start") + F.col("_row")).drop("_file", "_start", "_row")
    return placed.where(F.col("position") >= start) if stop is None else placed.where(F.col("position").between(start, stop - 1))


def first_rows(spark: SparkSession, path: str, schema: T.StructType, n: int) -> DataFrame:
    """The first ``n`` rows in their order."""
    return read_positions(spark, path, schema, 0, n).orderBy("position").drop("position")
