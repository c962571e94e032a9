"""Sets of hashes as bitmaps of a fixed size, to leave out early what can't be wanted.

A bitmap says "surely not" or "maybe". Its size is a parameter, never the number of members, so
it may be sent to every task; with many members it only lets more through. Who reads it must
decide exactly afterwards.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of one of the rows that Spark's bitmap functions make.
_ROW_BITS = 32_768
#: Bytes of a text taken at a time, and strings whose answer is kept.
SLICE_BYTES, KEPT = 1 << 22, 1 << 20


def bitmap(df: DataFrame, hash32: Column, bits: int) -> bytes:
    """The upper ``bits`` bits of each 32-bit hash as set bits: 2**bits bits, at least 2**15."""
    position = F.shiftrightunsigned(hash32.cast("long"), 32 - bits) + 1
    rows = (
        df.select(position.alias("p"))
        .groupBy(F.bitmap_bucket_number("p").alias("row"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("part"))
    )
    whole = bytearray((1 << bits) // 8)
    for row in rows.toLocalIterator():
        at = (row["row"] - 1) * _ROW_BITS // 8
        whole[at : at + len(row["part"])] = row["part"]
    return bytes(whole)


def holds(bitmap_: np.ndarray, bits: int, hash32: np.ndarray) -> np.ndarray:
    """Which 32-bit hashes may be members; ``bitmap_`` as bytes in numpy."""
    position = hash32.astype(np.int64) >> (32 - bits)
    return (bitmap_[position >> 3] >> (position & 7).astype(np.uint8)) & np.uint8(1) == 1


class Members:
    """Whether a string may be among those whose crc32 made the bitmap."""

    def __init__(self, bitmap_: bytes, bits: int):
        self._bitmap, self._shift, self._known = bitmap_, 32 - bits, {}

    def __call__(self, word: bytes) -> bool:
        answer = self._known.get(word)
        if answer is None:
            position = zlib.crc32(word) >> self._shift
            answer = bool(self._bitmap[position >> 3] >> (position & 7) & 1)
            if len(self._known) >= KEPT:
                self._known.clear()
            self._known[word] = answer
        return answer


def slices(data: bytes, separator: re.Pattern, size: int = SLICE_BYTES) -> Iterator[bytes]:
    """A text in parts of about ``size`` bytes that end after a separator, so no word is cut."""
    first = 0
    while len(data) - first > size:
        cut = separator.search(data, first + size)
        if cut is None:
            break
        yield data[first : cut.end()]
        first = cut.end()
    yield data[first:]
