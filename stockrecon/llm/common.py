"""Small helpers the operators share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockrecon.operators.prefilter import hash_set, may_be_in
from stockrecon.session import new_folder

#: Separators of words: space and U+0009 to U+000D, as characters and as a pattern.
SPACES = " \t\n\x0b\f\r"
SPACE = "[\\x20\\x09-\\x0D]"
NO_SPACE = "[^\\x20\\x09-\\x0D]"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back, which cuts the lineage.

    The files outlive any executor, so later stages never recompute earlier ones.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, once per application.

    A worker need not share the driver's folders or its path, so the sources go along as an
    archive that Spark sends to every executor. A package that was itself shipped stays as it is.
    """
    package, context = Path(__file__).resolve().parents[1], spark.sparkContext
    if context.applicationId in _shipped or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="sources-")) / f"{package.name}-{context.applicationId}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def map_batches(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` with a function that uses this package."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet, whatever the case of its letters."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def leave_out(docs: DataFrame, gone: DataFrame, name: dict[str, Column]) -> DataFrame:
    """The rows of ``docs`` whose name is not among ``gone``; nulls equal each other.

    ``name`` gives each column of ``gone`` as an expression over ``docs``, of the same type. A
    bitmap of the names lets most rows pass as they are read; only the others are joined.
    """
    hashed = F.xxhash64(*name.values())
    hashes = hash_set(gone, F.xxhash64(*name))
    aliases = {column: fresh(docs, f"gone_{column}") for column in name}
    same = [value.eqNullSafe(F.col(aliases[column])) for column, value in name.items()]
    listed = gone.select(*(F.col(column).alias(alias) for column, alias in aliases.items()))
    suspects = may_be_in(docs, hashes, hashed).join(listed, reduce(lambda a, b: a & b, same), "left_anti")
    return may_be_in(docs, hashes, hashed, how="left_anti").unionByName(suspects)


def words(text: Column) -> Column:
    """Words of a text as an array; null and blank texts have none."""

    def split(trimmed: Column) -> Column:
        none = F.array().cast("array<string>")
        return F.when(trimmed == "", none).otherwise(F.split(trimmed, SPACE + "+"))

    return let(F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES)), split)


def count_of(text: Column, pattern: str) -> Column:
    """How many code points of ``text`` match the character class ``pattern``."""
    return F.regexp_count(text, F.lit(pattern))
