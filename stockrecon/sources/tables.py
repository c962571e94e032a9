"""Reading, storing and registering tables and results."""

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockrecon.operators.series import SERIES
from stockrecon.schemas import KNOWN_ISSUES, RESULTS, TABLES

# Quotes are doubled within quoted fields and white space is kept, as other tools write it.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


#: Rows of a compressed text file, which is read by one task, at most.
PACKED_ROWS = 1_000_000
_FAST = {"zlib.compress.level": "BEST_SPEED"}


def _text_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType(), True) for name in schema.names])


def _typed(field: T.StructField) -> Column:
    """A text field in its type, NULL if it can't be read. Times may be ISO with ``T``, with a
    fraction, or a date alone; dates may be times."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        return column
    if isinstance(field.dataType, T.DateType):
        return column.try_cast("timestamp_ntz").cast("date")
    return column.try_cast(field.dataType)


def read_file(spark: SparkSession, path: str, schema: T.StructType, fmt: str) -> DataFrame:
    """Scan one table with a fixed schema.

    In CSV an empty field is missing, and unreadable ones become NULL, see ``unreadable``.
    """
    if fmt != "csv":
        return spark.read.schema(schema).format(fmt).load(path)
    text = spark.read.schema(_text_schema(schema)).options(**CSV_OPTIONS).csv(path)
    return text.select(*(_typed(field).alias(field.name) for field in schema))


def unreadable(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Fields of a CSV table that hold text their type can't be read from, one row per field."""
    schema = TABLES[table]
    text = spark.read.schema(_text_schema(schema)).options(**CSV_OPTIONS).csv(_path(folder, table, "csv"))
    lost = {
        field.name: F.col(field.name).isNotNull() & _typed(field).isNull()
        for field in schema
        if not isinstance(field.dataType, T.StringType)
    }
    details = [
        F.when(missing, F.concat(F.lit(f"{name} unreadable: "), F.col(name))) for name, missing in lost.items()
    ]
    rows = text.where(reduce(lambda a, b: a | b, lost.values()))
    return rows.select(
        F.lit("S1").alias("rule_id"),
        F.lit(table).alias("table_name"),
        F.col(schema.names[0]).alias("record_id"),
        F.explode(F.array_compact(F.array(*details))).alias("detail"),
    )


def write_file(df: DataFrame, path: str, fmt: str, mode: str = "overwrite", compression: str | None = None) -> None:
    """Store one table. In CSV, times keep their fraction, and text with a line break is refused,
    since files with such fields could not be split for reading. ``compression`` (as ``gzip``)
    packs CSV files, in parts of ``PACKED_ROWS`` rows; they are read like plain ones. They are packed
    at the fastest level: the usual one took five times as long for a sixth less."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = df.select(*(_plain(field).alias(field.name) for field in df.schema)).write.mode(mode)
        if compression is not None:
            writer = writer.options(compression=compression, maxRecordsPerFile=PACKED_ROWS, **_FAST)
        writer.options(**CSV_OPTIONS).csv(path)
    else:
        writer.format(fmt).save(path)


def _plain(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        problem = F.concat(F.lit(f"line break in {field.name}: "), column)
        broken = F.contains(column, F.lit("\r")) | F.contains(column, F.lit("\n"))
        return F.when(broken, F.raise_error(problem)).otherwise(column)
    return column.cast("string")


def _path(folder: str, name: str, fmt: str) -> str:
    return f"{folder.rstrip('/')}/{name}.{fmt}"


def read_table(spark: SparkSession, folder: str, name: str, fmt: str = "csv") -> DataFrame:
    """Scan one input table from ``<folder>/<table>.<fmt>`` (a file or a folder)."""
    return read_file(spark, _path(folder, name, fmt), TABLES[name], fmt)


def read_tables(spark: SparkSession, folder: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """Scan the eight input tables, each as :func:`read_table` does."""
    return {name: read_table(spark, folder, name, fmt) for name in TABLES}


def read_known_issues(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return read_file(spark, path, KNOWN_ISSUES, fmt)


def read_result(spark: SparkSession, folder: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Scan back a result written by ``sources.exports``."""
    return read_file(spark, _path(folder, name, fmt), RESULTS[name], fmt)


def load_tables(
    dfs: Mapping[str, DataFrame], target: str, mode: str = "overwrite", fmt: str = "parquet", compression: str | None = None
) -> dict[str, DataFrame]:
    """Store tables below the folder ``target``, replacing older ones, and scan them back."""
    stored = {}
    for name, df in dfs.items():
        path = _path(target, name, fmt)
        write_file(df, path, fmt, mode, compression)
        stored[name] = read_file(df.sparkSession, path, df.schema, fmt)
    return stored


def bucket_count(df: DataFrame, bytes_per_bucket: int = 1 << 30) -> int:
    """Buckets for a stored table: by its estimated bytes, and enough to keep all cores busy."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-size // bytes_per_bucket))


def store_snapshots(
    snapshots: DataFrame, table: str, buckets: int, mode: str = "overwrite", path: str | None = None
) -> DataFrame:
    """Store the snapshots as a catalog table in buckets by series, one file per bucket.

    The files go to the warehouse, or to ``path`` if given. Snapshots that are already laid out
    in as many parts by series are not shuffled again.

    Windows and joins on a series then read the buckets as they lie, without a shuffle.
    Only the snapshots suit this: a series has one of them per day, while its sales and
    movements have no bound and would make a bucket as hot as the product.
    """
    laid_out = snapshots.repartition(buckets, *SERIES)
    writer = laid_out.write.mode(mode).format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.bucketBy(buckets, *SERIES).sortBy(*SERIES, "snapshot_date").saveAsTable(table)
    return snapshots.sparkSession.table(table)


def register_views(spark: SparkSession, dfs: Mapping[str, DataFrame], prefix: str = "") -> list[str]:
    """Make frames available to ``spark.sql``, replacing older views of the same name."""
    for name, df in dfs.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + name for name in dfs]


def row_counts(dfs: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each table, as ``name, rows``."""
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows") for name, df in dfs.items()]
    return reduce(DataFrame.unionByName, counts)

