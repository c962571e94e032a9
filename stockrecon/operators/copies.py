"""Repeated stock movements: which rows are copies, and which copy is which.

Copies agree in branch, product, time, type, quantity and reference (no reference equals
no reference). Nearly all movements are single, so they are first counted by hash, and only
rows whose hash occurs more than once are compared by all columns. A group of copies may be
arbitrarily large, so nothing here gathers a whole group: groups are counted with partial sums,
and the copies of a large group are numbered in slices of the id range, whose sizes the primary
key bounds.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockrecon.functions import expressions as X
from stockrecon.operators.prefilter import hash_set, may_be_in, repeated_hashes
from stockrecon.operators.series import SERIES

# A window sees at most 2**SLICE_BITS ids of one group.
SLICE_BITS = 24

_SHARED = [*SERIES, "movement_time", "movement_type", "quantity"]

# The struct decides; its hash comes first so that sorts compare numbers.
_KEY = ["copy_hash", "copy_key"]


def _keyed(movements: DataFrame) -> DataFrame:
    """Movements as id and the columns that copies share, without repeating a column.

    The shared columns are one struct, whose fields compare NULL as equal. A missing and an
    empty reference are the same key, so which one it was is kept beside it.
    """
    key = F.struct(*_SHARED, F.coalesce("reference_id", F.lit("")).alias("reference_id"))
    return movements.select(
        "movement_id",
        F.xxhash64(key).alias("copy_hash"),
        key.alias("copy_key"),
        F.col("reference_id").isNotNull().alias("has_reference"),
    )


def _unkeyed(number: Column) -> list[Column]:
    """The movement columns again, and the number."""
    reference = F.when(F.col("has_reference"), F.col("copy_key.reference_id")).alias("reference_id")
    shared = [F.col(f"copy_key.{name}").alias(name) for name in _SHARED]
    return [F.col("movement_id"), *shared, reference, number.cast("bigint").alias("duplicate_number")]


def _suspects(movements: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Hashes of movements that may have copies, as a set of bounded size.

    Only hashes and counts are shuffled for it; stored ``groups`` give it without that.
    """
    if groups is not None:
        return hash_set(groups, F.col("copy_hash"))
    return hash_set(repeated_hashes(_keyed(movements), F.col("copy_hash")), F.col("hashed"))


def copy_groups(movements: DataFrame) -> DataFrame:
    """Groups of equal movements with more than one row, as ``copy_hash, copy_key, copies``."""
    return _groups(may_be_in(_keyed(movements), _suspects(movements), F.col("copy_hash")))


def _groups(keyed: DataFrame) -> DataFrame:
    return keyed.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def duplicate_days(movements: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """Surplus copies per branch, product and day.

    The count needs no numbering: a group of n copies has n - 1 surplus rows. ``groups`` may
    give ``copy_groups(movements)`` if they are stored.
    """
    groups = copy_groups(movements) if groups is None else groups
    day = X.day_of(F.col("copy_key.movement_time")).alias("issue_date")
    series = [F.col(f"copy_key.{name}").alias(name) for name in SERIES]
    return groups.groupBy(*series, day).agg(F.sum(F.col("copies") - 1).alias("duplicate_count"))


def duplicate_movements(
    movements: DataFrame, slice_bits: int = SLICE_BITS, groups: DataFrame | None = None
) -> DataFrame:
    """Every copy after the first, numbered from 2 in the order of movement_id.

    Movements are read with a filter that single ones seldom pass; what passes it is shuffled by
    all columns. With stored ``groups`` the movements need not be counted again.
    """
    suspects = may_be_in(_keyed(movements), _suspects(movements, groups), F.col("copy_hash"))
    groups = _groups(suspects) if groups is None else groups
    return _numbered_copies(suspects, groups, slice_bits).where(F.col("duplicate_number") > 1)


def number_duplicates(movements: DataFrame, slice_bits: int = SLICE_BITS) -> DataFrame:
    """All movements with their number among equal ones; only possible copies are shuffled."""
    keyed, found = _keyed(movements), _suspects(movements)
    suspects = may_be_in(keyed, found, F.col("copy_hash"))
    groups = _groups(suspects)
    small, large = _split(groups, slice_bits)
    single = may_be_in(keyed, found, F.col("copy_hash"), how="left_anti")
    alone = suspects.join(large, _KEY, "left_anti").join(small, _KEY, "left_anti")
    numbered = _numbered_copies(suspects, groups, slice_bits)
    return single.unionByName(alone).select(_unkeyed(F.lit(1))).unionByName(numbered)


def _split(groups: DataFrame, slice_bits: int) -> tuple[DataFrame, DataFrame]:
    """Groups that fit one window, and the larger ones.

    At most rows / 2**slice_bits groups are large: 60,000 per 10**12 movements at the default,
    from which on they are broadcast; smaller slices leave the choice to Spark. Usually there
    are none, and AQE drops what is joined to them.
    """
    size = 1 << slice_bits
    large = groups.where(F.col("copies") > size).select(*_KEY)
    return groups.where(F.col("copies") <= size), F.broadcast(large) if slice_bits >= SLICE_BITS else large


def _numbered_copies(keyed: DataFrame, groups: DataFrame, slice_bits: int) -> DataFrame:
    """Those of the keyed rows that have copies, numbered from 1 within their group.

    Rows of large groups leave before anything is shuffled by group, and are numbered in
    slices of their ids instead.
    """
    small, large = _split(groups, slice_bits)
    in_group = Window.partitionBy(*_KEY).orderBy("movement_id")
    few = keyed.join(large, _KEY, "left_anti").join(small, _KEY).select(_unkeyed(F.row_number().over(in_group)))
    many = _numbered_in_slices(keyed.join(large, _KEY), slice_bits).select(_unkeyed(F.col("number")))
    return few.unionByName(many)


def _numbered_in_slices(rows: DataFrame, slice_bits: int) -> DataFrame:
    """Add the number of each row of a large group.

    The position in a slice of at most 2**slice_bits ids is added to the rows of earlier
    slices. Group and slice form one key, so that no join can fall back to the group alone.
    """
    sliced = rows.withColumn("slice_key", F.struct(*_KEY, F.shiftright("movement_id", slice_bits).alias("slice")))
    position = F.row_number().over(Window.partitionBy("slice_key").orderBy("movement_id"))
    offsets = _slice_offsets(sliced, slice_bits)
    return (
        sliced.withColumn("position", position)
        .join(offsets, "slice_key")
        .withColumn("number", F.col("position") + F.col("offset"))
    )


def _slice_offsets(sliced: DataFrame, slice_bits: int) -> DataFrame:
    """Rows of a group that precede each of its slices, as a running sum on two levels.

    Slices are collected into blocks of 2**slice_bits slices: the first window runs inside
    a block, the second over the blocks of a group, so each sees a bounded number of rows
    however the ids are spread.
    """
    block = F.shiftright("slice_key.slice", slice_bits).alias("block")
    group = [F.col(f"slice_key.{name}").alias(name) for name in _KEY]
    slices = (
        sliced.groupBy("slice_key").agg(F.count(F.lit(1)).alias("rows")).withColumn("block_key", F.struct(*group, block))
    )
    inside = _rows_before(slices, "inside", ["block_key"], "slice_key.slice")
    blocks = slices.groupBy("block_key").agg(F.sum("rows").alias("rows"))
    ahead = _rows_before(blocks, "ahead", [f"block_key.{name}" for name in _KEY], "block_key.block")
    return inside.join(ahead.drop("rows"), "block_key").select(
        "slice_key", (F.col("inside") + F.col("ahead")).alias("offset")
    )


def _rows_before(df: DataFrame, name: str, keys: list[str], order: str) -> DataFrame:
    earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, X.or_zero(F.sum("rows").over(earlier)))
