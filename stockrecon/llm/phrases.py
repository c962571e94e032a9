"""Phrase collocation mining: frequent n-grams by Misra-Gries summaries, then exact counts.

* **First pass.** Every n-gram of one to three words is named by a hash, whose upper half deals it to
  a hash partition. A task counts the n-grams of its texts and passes on one summary per partition:
  the lower half of each hash with its count, and the mass, which is the sum of these counts. Where
  summaries of a partition meet, their masses come first, so the capacity is known: more than
  mass / threshold. Summaries are merged; whenever more than ``capacity`` counters are left, the
  count of the first one beyond is subtracted from all and what is not above zero is dropped. That
  lowers no counter by more than mass / (capacity + 1), which is below the threshold, so every
  n-gram that is as frequent as the threshold survives. A counter that, with all that was
  subtracted, can't reach the threshold goes as well.
* **Second pass.** The survivors become a bitmap of fixed size, and n-grams that hit it are counted as
  strings: exactly, and per task before they are shuffled. Hashes, shared bits and summaries only
  decide what is counted, never a count.

Memory is bounded by the capacity of a partition (a tenth of its mass, and the number of partitions
grows with the text) and by the n-grams a task holds before it passes them on. Candidates that occur
in a third of all texts are one row per task.

Defined results: null and empty texts hold no words, a null language is ``und``; repeated rows count
as often as they occur; long texts are read in parts that end where a piece ends; equal scores go
by count, then by the bytes of the phrase. An empty table gives an empty result. Extra columns do
not matter.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockrecon.llm.bitmaps import bitmap, holds, slices
from stockrecon.llm.common import durable, map_batches
from stockrecon.llm.hashing import mix

#: Occurrences that make a phrase a candidate, words of the longest one, phrases listed per language.
THRESHOLD, LONGEST, LISTED = 10, 3, 2000
#: A candidate goes if a longer one around it has this share of its occurrences, in per cent.
COVERED = 50
#: Bytes of text per hash partition; a partition then has a mass of about as many n-grams.
PART_BYTES = 1 << 23
#: 2**27 bits, 16 MB, tell which n-grams survived.
BITS = 27
#: Distinct words and occurrences of n-grams a task holds before it passes its counts on.
KEPT_WORDS, KEPT_GRAMS = 1 << 18, 4 << 20
#: Bytes of short texts that are counted together.
JOINED_BYTES = 1 << 20
#: Keys by which the ranking is cut for the first time, so that no task sorts a whole language.
SALTS = 256
#: A word's number takes 21 bits of a key; 0 stands for the end of a piece.
_WIDTH = 21
_MASK = np.int64((1 << _WIDTH) - 1)
_SHIFTS = [np.int64(_WIDTH * k) for k in range(LONGEST - 1, -1, -1)]
#: Keys whose hashes are made at a time.
_STEP = 1 << 18
_TOKEN = re.compile(rb"[^\x20\x09.,;:!?\x0A-\x0D]+|[.,;:!?\x0A-\x0D]")
_END = re.compile(rb"[.,;:!?\x0A-\x0D]")
_ENDS = [bytes([c]) for c in b".,;:!?\n\x0b\x0c\r"]


class _Numbers(dict):
    """Numbers of the words of one language; an unknown word gets the next one."""

    def __init__(self, lang: str, words: list[bytes], langs: list[str]):
        super().__init__(dict.fromkeys(_ENDS, 0))
        self._lang, self._words, self._langs = lang, words, langs

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self._words)
        self._words.append(word)
        self._langs.append(self._lang)
        return number


class Counts:
    """Exact counts of the n-grams of some texts. A key holds the numbers of up to three words."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.words: list[bytes] = [b""]
        self.langs: list[str] = [""]
        self._numbers: dict[str, _Numbers] = {}
        self._keys: list[np.ndarray] = []
        self._held = 0

    @property
    def full(self) -> bool:
        return len(self.words) > KEPT_WORDS or self._held > KEPT_GRAMS

    def add(self, lang: str, part: bytes) -> None:
        """Count the n-grams of lower-cased text that ends where a piece ends."""
        if lang not in self._numbers:
            self._numbers[lang] = _Numbers(lang, self.words, self.langs)
        tokens = _TOKEN.findall(part)
        ids = np.fromiter(map(self._numbers[lang].__getitem__, tokens), np.int64, len(tokens))
        key, whole = ids, ids > 0
        self._keys.append(key[whole])
        for size in range(2, LONGEST + 1):
            word = ids[size - 1 :]
            key = key[: len(word)] << _WIDTH | word
            whole = whole[: len(word)] & (word > 0)
            self._keys.append(key[whole])
        self._held += sum(map(len, self._keys[-LONGEST:]))

    def take(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys, counts and hashes of the distinct n-grams; done once."""
        keys = np.concatenate([np.empty(0, np.int64), *self._keys])
        self._keys = []
        keys.sort()
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
        counts = np.diff(starts, append=len(keys)).astype(np.uint32)
        keys = keys[starts]
        seeds = {lang: zlib.crc32(lang.encode()) for lang in ("", *self._numbers)}
        named = (zlib.crc32(word, seeds[lang]) << 32 | zlib.adler32(word) for lang, word in zip(self.langs, self.words))
        hashes = mix(np.fromiter(named, np.uint64, len(self.words)))
        name = np.zeros(len(keys), np.uint64)
        for first in range(0, len(keys), _STEP):
            some, own = keys[first : first + _STEP], name[first : first + _STEP]
            for shift in _SHIFTS:
                part = some >> shift & _MASK
                own[:] = np.where(part > 0, mix(own ^ hashes[part]), own)
        return keys, counts, name

    def phrases(self, keys: np.ndarray) -> Iterator[tuple[pa.Array, pa.Array, pa.Array]]:
        """Languages, texts and numbers of words of n-grams whose keys are in order, some at a time."""
        langs, words = pa.array(self.langs, pa.string()), pa.array(self.words, pa.binary())
        bounds = np.searchsorted(keys, [1 << _WIDTH * size for size in range(LONGEST + 1)])
        for size, first, last in zip(range(1, LONGEST + 1), bounds[:-1].tolist(), bounds[1:].tolist()):
            for at in range(first, last, _STEP):
                some = keys[at : min(at + _STEP, last)]
                parts = [pa.array(some >> shift & _MASK) for shift in _SHIFTS[LONGEST - size :]]
                taken = [words.take(part) for part in parts]
                text = pc.binary_join_element_wise(*taken, b" ") if size > 1 else taken[0]
                yield langs.take(parts[0]), text.cast(pa.string()), pa.array(np.full(len(some), size, np.int32))


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[starts], np.add.reduceat(counts[order], starts)


def _joined(texts: pa.Array, rows: list[int]) -> Iterator[bytes]:
    """Lower-cased texts of some rows, about ``JOINED_BYTES`` at a time; a line end keeps them apart."""
    joined, size = [], 0
    for row in rows:
        joined.append((texts[row].as_py() or "").encode().lower())
        size += len(joined[-1])
        if size >= JOINED_BYTES:
            yield b"\n".join([*joined, b""])
            joined, size = [], 0
    yield b"\n".join([*joined, b""])


Made = Callable[[Counts], Iterator[pa.RecordBatch]]


def _by_portions(batches: Iterator[pa.RecordBatch], made: Made) -> Iterator[pa.RecordBatch]:
    """What ``made`` makes of the n-grams of a task's rows, in portions of bounded size."""
    counts = Counts()
    for batch in batches:
        by_lang: dict[str, list[int]] = {}
        for row, lang in enumerate(batch.column("lang").to_pylist()):
            by_lang.setdefault(lang, []).append(row)
        for lang, rows in by_lang.items():
            for data in _joined(batch.column("text"), rows):
                for part in slices(data, _END, JOINED_BYTES):
                    counts.add(lang, part)
                    if counts.full:
                        yield from made(counts)
                        counts.clear()
    yield from made(counts)


class MisraGries:
    """A summary of counts by 32-bit name with at most ``capacity`` counters."""

    def __init__(self, capacity: int):
        self.capacity, self.lowered = capacity, 0
        self._names, self._counts, self._held = [np.empty(0, np.uint32)], [np.empty(0, np.int64)], 0

    def merge(self, names: np.ndarray, counts: np.ndarray) -> None:
        self._names.append(names)
        self._counts.append(counts.astype(np.int64))
        self._held += len(names)
        if self._held > 2 * self.capacity:
            self._reduce()

    def _reduce(self) -> None:
        names, counts = summed(np.concatenate(self._names), np.concatenate(self._counts))
        if len(names) > self.capacity:
            place = len(counts) - self.capacity - 1
            beyond = int(np.partition(counts, place)[place])  # the largest count without a counter
            stay = counts > beyond
            names, counts = names[stay], counts[stay] - beyond
            self.lowered += beyond
        self._names, self._counts, self._held = [names], [counts], len(names)

    def survivors(self, threshold: int) -> np.ndarray:
        """Names that may have reached the threshold; all that have are among them."""
        self._reduce()
        return self._names[0][self._counts[0] + self.lowered >= threshold]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")


def summaries(texts: DataFrame, parts: int) -> DataFrame:
    """``part``, ``mass``, ``names`` and ``counts``: per task a row of mass, then one of counters, per partition."""
    schema = "part int, kind int, mass long, names binary, counts binary"
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]

    def made(portion: Counts) -> Iterator[pa.RecordBatch]:
        _, counts, hashes = portion.take()
        part = ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        bounds = np.searchsorted(part[order], np.arange(parts + 1))
        names, counts = hashes.astype("<u4")[order], counts.astype("<u4")[order]
        rows = []
        for p in np.flatnonzero(np.diff(bounds)).tolist():
            here = slice(bounds[p], bounds[p + 1])
            rows.append((p, 0, int(counts[here].sum(dtype=np.int64)), None, None))
            rows.append((p, 1, 0, names[here].tobytes(), counts[here].tobytes()))
        columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
        yield pa.record_batch(columns, names=["part", "kind", "mass", "names", "counts"])

    return map_batches(texts, lambda batches: _by_portions(batches, made), schema)


def survivors(summarised: DataFrame, threshold: int) -> DataFrame:
    """``name``, the lower half of the hash, of every n-gram that may be as frequent as ``threshold``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, mass, summary = None, 0, MisraGries(0)

        def left() -> pa.RecordBatch:
            return pa.record_batch([pa.array(summary.survivors(threshold), pa.int64())], names=["name"])

        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != part:
                    if part is not None:
                        yield left()
                    part, mass = row["part"], 0
                if row["kind"] == 0:
                    mass += row["mass"]
                    summary = MisraGries(mass // threshold + 1)
                else:
                    summary.merge(np.frombuffer(row["names"], "<u4"), np.frombuffer(row["counts"], "<u4"))
        if part is not None:
            yield left()

    met = summarised.repartition("part").sortWithinPartitions("part", "kind")
    return map_batches(met, run, "name long")


def counted(texts: DataFrame, members: bytes, bits: int) -> DataFrame:
    """Exact counts ``lang``, ``phrase``, ``size`` (in words) and ``f`` of n-grams that may have survived.

    The rows of size 0 hold the number of all words of a language.
    """
    schema = "lang string, phrase string, size int, f long"
    kinds, names = [pa.string(), pa.string(), pa.int32(), pa.int64()], ["lang", "phrase", "size", "f"]

    def made(portion: Counts) -> Iterator[pa.RecordBatch]:
        keys, counts, hashes = portion.take()
        chosen = holds(np.frombuffer(members, np.uint8), bits, hashes.astype(np.uint32))
        single = np.searchsorted(keys, 1 << _WIDTH)
        words: dict[str, int] = {}
        for key, count in zip(keys[:single].tolist(), counts[:single].tolist()):
            words[portion.langs[key]] = words.get(portion.langs[key], 0) + count
        rows = [(lang, "", 0, count) for lang, count in words.items()]
        yield pa.record_batch([pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)], names=names)
        keys, counts, at = keys[chosen], counts[chosen].astype(np.int64), 0
        for columns in portion.phrases(keys):
            yield pa.record_batch([*columns, pa.array(counts[at : at + len(columns[0])])], names=names)
            at += len(columns[0])

    grams = map_batches(texts, lambda batches: _by_portions(batches, made), schema)
    return grams.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f"))


def frequent(docs: DataFrame, threshold: int = THRESHOLD, part_bytes: int = PART_BYTES, bits: int = BITS) -> DataFrame:
    """``lang``, ``phrase``, ``size`` and exact ``f`` of every n-gram as frequent as the threshold; size 0: all words."""
    texts = _texts(docs)
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    names = durable(survivors(summaries(texts, 1 + size // part_bytes), threshold), "survivors")
    members = bitmap(names, F.col("name"), bits)
    exact = counted(texts, members, bits)
    return durable(exact.where((F.col("f") >= threshold) | (F.col("size") == 0)), "counted")


def _part(first: int, last: int | None = None) -> Column:
    """Words ``first`` to ``last`` (from 0, exclusive) of a phrase."""
    words = F.split("phrase", " ")
    count = F.size(words) - first if last is None else F.lit(last - first)
    return F.array_join(F.slice(words, F.lit(first + 1), count), " ")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, listed: int = LISTED, covered: int = COVERED) -> DataFrame:
    """The best phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score``."""
    grams = frequent(docs, threshold)
    candidates = grams.where("size > 1").withColumnRenamed("f", "a")
    longer = candidates.where(F.col("size") == LONGEST)
    # Both shorter phrases within a longer one, with its count; the highest decides.
    around = (
        longer.select("lang", "a", F.explode(F.array(_part(0, 2), _part(1, 3))).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("around"))
    )
    absorbed = F.coalesce(100 * F.col("around") >= covered * F.col("a"), F.lit(False))
    alone = candidates.join(around, ["lang", "phrase"], "left").where(~absorbed)
    halves = F.when(
        F.col("size") == 2, F.array(F.struct(F.lit(1).alias("cut"), _part(0, 1).alias("x"), _part(1).alias("y")))
    ).otherwise(F.array(*[F.struct(F.lit(k).alias("cut"), _part(0, k).alias("x"), _part(k).alias("y")) for k in (1, 2)]))
    cut = alone.select("lang", "phrase", "a", F.explode(halves).alias("h")).select("lang", "phrase", "a", "h.*")
    f_of = grams.where("size > 0").select("lang", "phrase", "f")
    left = f_of.select("lang", F.col("phrase").alias("x"), F.col("f").alias("l"))
    right = f_of.select("lang", F.col("phrase").alias("y"), F.col("f").alias("r"))
    # 18 digits for a count of words: products stay within the 38 digits of a decimal.
    big = {name: F.col(name).cast("decimal(15,0)") for name in ("a", "l", "r")}
    ratio = F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (big["a"] * big["a"]), big["l"] * big["r"])
    scored = cut.join(left, ["lang", "x"]).join(right, ["lang", "y"]).withColumn("score", ratio.cast("long"))
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    ranked = lowest.select("lang", "phrase", "a", "best.l", "best.r", "best.score")
    for keys in (["lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))], ["lang"]):
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.desc("a"), "phrase")
        ranked = ranked.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= listed)
    total = grams.where("size = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
