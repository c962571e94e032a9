"""Leaving out, before a shuffle, rows that can't have a partner.

Sets of numbers are kept 64 to a word, so a set is a table ``word, mask``. Hashed down to
2**BITS positions such a table has at most 2**BITS / 64 rows, whatever it was made from, and that
bound allows it to be broadcast. Who is not in it has no partner; who is in it may have one and is
then compared exactly, so the number of positions decides how much is shuffled but never a result.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: 2**24 positions: at most 262,144 rows of 16 bytes.
BITS = 24
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def word_of(number: Column) -> Column:
    return F.shiftright(number.cast("bigint"), 6)


def bit_of(number: Column) -> Column:
    """The position of a number within its word."""
    return number.cast("bigint").bitwiseAND(F.lit(63)).cast("int")


def mask_of(number: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), bit_of(number))


def number_set(df: DataFrame, number: Column) -> DataFrame:
    """A set of numbers as ``word, mask``, each word once; partial sums before the shuffle.

    Numbers that lie close together, as ids of orders in a file do, take 2 bits each.
    """
    return df.groupBy(word_of(number).alias("word")).agg(F.bit_or(mask_of(number)).alias("mask"))


def contains(mask: Column, number: Column) -> Column:
    return F.getbit(F.coalesce(mask, F.lit(0).cast("bigint")), bit_of(number)) == 1


def _position(hashed: Column, bits: int) -> Column:
    return F.shiftrightunsigned(hashed, 64 - bits)


def hash_set(df: DataFrame, hashed: Column, bits: int = BITS) -> DataFrame:
    """Positions of 64-bit hashes as ``word, mask``: at most 2**bits / 64 rows."""
    return number_set(df, _position(hashed, bits))


def may_be_in(df: DataFrame, hashes: DataFrame, hashed: Column, bits: int = BITS, how: str = "left_semi") -> DataFrame:
    """Rows whose hash may be among ``hashes``, a ``hash_set``; with ``left_anti`` those surely not in it."""
    small = F.broadcast(hashes.select(F.col("word").alias("_word"), F.col("mask").alias("_mask")))
    at = _position(hashed, bits)
    return df.join(small, (word_of(at) == small["_word"]) & contains(small["_mask"], at), how)


def repeated_hashes(df: DataFrame, hashed: Column) -> DataFrame:
    """``hashed`` values that occur more than once. Only the hash and a count are shuffled."""
    counts = df.groupBy(hashed.alias("hashed")).agg(F.count(F.lit(1)).alias("rows"))
    return counts.where(F.col("rows") > 1).select("hashed")


def dense(df: DataFrame, key: str) -> bool:
    """Whether ids lie so close that a word holds four of them or more; one scan of the column."""
    if not isinstance(df.schema[key].dataType, _INTEGERS):
        return False
    wide = F.max(key).cast("decimal(20,0)") - F.min(key).cast("decimal(20,0)")
    return bool(df.agg(F.coalesce(wide < 16 * F.count(key), F.lit(False))).first()[0])


def may_repeat(df: DataFrame, keys: list[str], bits: int = BITS) -> DataFrame:
    """The rows of ``df`` whose key may occur more than once; no row with a repeated key is lost.

    If the last key is an integer or a day, rows are counted 64 neighbours to a word, within the
    other keys: a word without repeated keys has as many rows as bits. That shuffles one row per
    word instead of every key, which pays for ids and days with few gaps. Other keys are counted
    by hash. Rows with a NULL in the key stay.
    """
    missing = reduce(lambda a, b: a | b, [F.col(key).isNull() for key in keys])
    present = df.where(~missing)
    *others, last = keys
    kind = df.schema[last].dataType
    if isinstance(kind, (*_INTEGERS, T.DateType)):
        number = F.unix_date(last) if isinstance(kind, T.DateType) else F.col(last)
        hashed = F.xxhash64(*others, word_of(number))
        words = present.groupBy(*others, word_of(number).alias("_word")).agg(
            F.count(F.lit(1)).alias("_rows"), F.bit_or(mask_of(number)).alias("_mask")
        )
        suspects = words.where(F.col("_rows") > F.bit_count("_mask")).select(
            F.xxhash64(*others, "_word").alias("hashed")
        )
    else:
        hashed = F.xxhash64(*keys)
        suspects = repeated_hashes(present, hashed)
    found = may_be_in(present, hash_set(suspects, F.col("hashed"), bits), hashed, bits)
    return found.unionByName(df.where(missing))
