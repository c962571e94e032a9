"""Tables that change together: written aside, then switched by one manifest.

A load writes its tables into new folders below ``<target>/data``. Nothing reads them until one
small file below ``<target>/manifests`` names them; that file appears as a whole when Spark
commits the job that writes it, so readers see all tables of a load or none. A load that breaks
off leaves the last state as it is. A manifest lists the folders of each table, so a load may
also add rows to a table without touching the rows it has. One load runs at a time.

Rows are counted while they are written, so counts need no scan.
"""

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockrecon.sources.tables import read_file, write_file

_MANIFEST = "version bigint, note string, name string, paths array<string>, fmt string, columns string, rows bigint"


def write_counted(df: DataFrame, path: str, fmt: str, mode: str = "overwrite") -> int:
    """Store a table and return how many rows it has, without reading it again."""
    seen = Observation()
    write_file(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, fmt, mode)
    return seen.get.get("rows", 0)


def manifests(spark: SparkSession, target: str) -> DataFrame:
    """``version, note, name, paths, fmt, columns, rows``: the tables of every load that was finished."""
    folder = f"{target.rstrip('/')}/manifests"
    try:
        return spark.read.schema(_MANIFEST).option("recursiveFileLookup", "true").parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _MANIFEST)


def _entries(spark: SparkSession, target: str, version: int | None) -> dict:
    """The tables of one version, the last one by default, by name."""
    known = manifests(spark, target)
    if version is None:
        version = known.agg(F.max("version")).first()[0]
    return {row["name"]: row for row in known.where(F.col("version") == version).collect()}


def _scan(spark: SparkSession, target: str, entry) -> DataFrame:
    schema = T.StructType.fromDDL(entry["columns"])
    paths = [f"{target.rstrip('/')}/{path}" for path in entry["paths"]]
    if entry["fmt"] == "csv":
        parts = [read_file(spark, path, schema, "csv") for path in paths]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        return whole
    return spark.read.schema(schema).format(entry["fmt"]).load(paths)


def current(spark: SparkSession, target: str, version: int | None = None) -> dict[str, DataFrame]:
    """The tables of the last finished load, or of an earlier version that is still there."""
    return {name: _scan(spark, target, entry) for name, entry in _entries(spark, target, version).items()}


def note(spark: SparkSession, target: str) -> str | None:
    """What the last finished load noted; None before the first one."""
    return next((entry["note"] for entry in _entries(spark, target, None).values()), None)


def row_counts(spark: SparkSession, target: str, version: int | None = None) -> DataFrame:
    """Rows of each table, as ``name, rows``, from the manifest."""
    known = manifests(spark, target)
    wanted = known.agg(F.max("version").alias("wanted")) if version is None else None
    chosen = known.where(F.col("version") == version) if wanted is None else known.join(wanted, F.col("version") == F.col("wanted"))
    return chosen.select("name", "rows")


class Load:
    """Tables being written. Nothing of them is visible before ``commit``."""

    def __init__(self, spark: SparkSession, target: str, fmt: str = "parquet"):
        self._spark, self._target, self._fmt = spark, target.rstrip("/"), fmt
        self._before = _entries(spark, target, None)
        self._written: dict[str, dict] = {}

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Store a table aside and scan it back, for later parts of the same load."""
        path = f"data/{name}-{uuid.uuid4().hex}.{self._fmt}"
        rows = write_counted(df, f"{self._target}/{path}", self._fmt, "errorifexists")
        entry = {"paths": [path], "fmt": self._fmt, "columns": _ddl(df.schema), "rows": rows}
        self._written[name] = entry
        return _scan(self._spark, self._target, entry)

    def commit(self, note: str = "", append: set[str] = frozenset()) -> int:
        """Make the written tables visible, all at once; returns the version.

        Tables named in ``append`` keep the rows they had; other written ones are replaced, and
        tables that were not written stay.
        """
        version = 1 + max((entry["version"] for entry in self._before.values()), default=0)
        rows = []
        for name in {**self._before, **self._written}:
            old, new = self._before.get(name), self._written.get(name)
            entry = new or old
            paths, count = list(entry["paths"]), entry["rows"]
            if new and old and name in append:
                if (old["columns"], old["fmt"]) != (new["columns"], new["fmt"]):
                    raise ValueError(f"{name}: other columns or format than before")
                paths, count = [*old["paths"], *paths], old["rows"] + count
            rows.append((version, note, name, paths, entry["fmt"], entry["columns"], count))
        listed = self._spark.createDataFrame(rows, _MANIFEST).coalesce(1)
        listed.write.mode("errorifexists").parquet(f"{self._target}/manifests/{version:012d}-{uuid.uuid4().hex}")
        return version


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)


def refresh_tables(
    spark: SparkSession, dfs: Mapping[str, DataFrame], target: str, fmt: str = "parquet"
) -> dict[str, DataFrame]:
    """Replace all tables together; readers see the old ones until the last is written."""
    load = Load(spark, target, fmt)
    for name, df in dfs.items():
        load.write(name, df)
    return current(spark, target, load.commit())


def forget(spark: SparkSession, target: str, keep: int = 2) -> list[str]:
    """Delete folders that none of the last ``keep`` versions names; returns their paths.

    Readers of older versions must be done, and no load may be running.
    """
    known = manifests(spark, target)
    versions = [row[0] for row in known.select("version").distinct().sort(F.desc("version")).limit(keep).collect()]
    wanted = known.where(F.col("version").isin(versions)).select(F.explode("paths")).distinct().collect()
    used = {row[0] for row in wanted}
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}/data")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for status in files.listStatus(path) if files.exists(path) else ():
        name = f"data/{status.getPath().getName()}"
        if name not in used and files.delete(status.getPath(), True):
            gone.append(name)
    return sorted(gone)
