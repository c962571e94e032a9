"""Packing documents into sequences by minimum bin slack.

Documents become token ids with an end id and are cut into pieces of the full length and one
remainder. Full pieces fill a sequence alone. The remainders are counted by length, at most
``length - 1`` counts whatever the size of the corpus. From the counts sequences are planned:
the longest remainder left opens a sequence, a subset-sum over bit sets finds the multiset of
remaining lengths that fills the rest closest, walking back through the sets gives its counts,
and the pattern is used as often as the counts allow. Pieces are numbered by length (within
their partition, plus the counts of earlier partitions) and look their place up in the plan, so
no group of pieces is ever gathered or sorted in one task.

``pack_in_order`` packs a mix: documents keep to the order of their blocks. The pieces of
``RANGE_BLOCKS`` blocks that follow each other are planned by themselves, their sequences are
shuffled, and sequences are numbered range by range, so that every stretch of sequences has the
sources that its stretch of the mix has.

Defined results: a null text is empty and has the end id alone; repeated rows are packed as
often as they occur; doc_id may be null; without documents there is no sequence; extra columns
do not matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stockrecon.llm import pfair
from stockrecon.llm.common import durable, map_batches
from stockrecon.llm.tokens import SLICE_CHARS, default_ranks, encoder

LENGTH = 1024
#: Blocks of a mix whose pieces are packed together; such ranges whose sequences are counted together.
RANGE_BLOCKS, RANGE_GROUP = 16, 4_096
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, nth long"


def pieces(docs: DataFrame, length: int = LENGTH, ranks: str | None = None, with_ids: bool = False, mixed: bool = False) -> DataFrame:
    """One row per piece; ``nth`` numbers the pieces of a length within their partition ``part``.

    ``with_ids`` adds the ids themselves as an array, ``mixed`` the ``source`` and ``place`` of the document.
    """
    path = ranks or default_ranks()
    kinds = [(c.split()[0], pa.int32() if c.endswith(" int") else pa.int64()) for c in PIECES.split(", ")]
    kinds += [("ids", pa.list_(pa.int64()))] if with_ids else []
    kinds += [("source", pa.string()), ("place", pa.int64())] if mixed else []
    out = pa.schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), [0] * (length + 1)
        for batch in batches:
            names, texts = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
            more = list(zip(*(batch.column(c).to_pylist() for c in ("source", "place")))) if mixed else [()] * len(texts)
            first = 0
            while first < len(texts):
                last, chars = first + 1, len(texts[first])
                while last < len(texts) and chars + len(texts[last]) <= SLICE_CHARS:
                    chars += len(texts[last])
                    last += 1
                ids, bounds = encoder(path).encode(texts[first:last])
                rows = []
                for name, extra, a, b in zip(names[first:last], more[first:last], bounds[:-1].tolist(), bounds[1:].tolist()):
                    for start in range(a, b, length):
                        end = min(start + length, b)
                        size = end - start
                        row = (name, start - a, size, zlib.crc32(ids[start:end]), b - a, part, seen[size])
                        rows.append((row + (ids[start:end],) if with_ids else row) + extra)
                        seen[size] += 1
                yield pa.record_batch([pa.array(c, t) for c, (_, t) in zip(zip(*rows), kinds)], schema=out)
                first = last

    schema = PIECES + (", ids array<long>" if with_ids else "") + (", source string, place long" if mixed else "")
    taken = [F.coalesce("source", F.lit("")).alias("source"), pfair.place_of().alias("place")] if mixed else []
    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *taken), run, schema)


def best_fill(counts: np.ndarray, room: int) -> dict[int, int]:
    """How many of each length fill ``room`` closest without passing it.

    Bit s of a set says that lengths taken so far can add up to s. Longer ones come first and
    the search ends once the room can be filled exactly.
    """
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for size in np.flatnonzero(counts[: room + 1])[::-1].tolist():
        left, times = min(int(counts[size]), room // size), 1
        while left > 0:
            taken = min(times, left)
            steps.append((size, taken, reach))
            reach |= (reach << (size * taken)) & mask
            left -= taken
            times *= 2
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for size, taken, before in reversed(steps):
        if not before >> total & 1:
            total -= size * taken
            used[size] = used.get(size, 0) + taken
    return used


def plan(counts: np.ndarray, first: int = 0) -> np.ndarray:
    """Rows (length, rank from, rank to, sequence, per sequence, offset), sorted by length and rank.

    ``counts[s]``: remainders of length s. Remainders of a length with rank r from a row's first
    rank on lie in ``sequence + (r - from) // per`` at ``offset + length * ((r - from) % per)``.
    """
    capacity, left, given = len(counts), counts.astype(np.int64).copy(), np.zeros(len(counts), np.int64)
    rows, sequence = [], first
    while left.any():
        longest = int(np.flatnonzero(left)[-1])
        left[longest] -= 1
        used = best_fill(left, capacity - longest)
        left[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        times = min(int(left[size]) // n for size, n in used.items())
        offset = 0
        for size in sorted(used, reverse=True):
            n = used[size]
            rows.append((size, given[size], given[size] + times * n, sequence, n, offset))
            given[size] += times * n
            left[size] -= times * n
            offset += size * n
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 6)


def pack(docs: DataFrame, length: int = LENGTH, ranks: str | None = None, with_ids: bool = False) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``, their place in it."""
    cut = durable(pieces(docs, length, ranks, with_ids), "pieces")
    counted = durable(cut.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    totals = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    counts = np.zeros(length, np.int64)
    for size, n in totals.items():
        if size < length:
            counts[size] = n
    full = int(totals.get(length, 0))
    rows = plan(counts, full)
    if full:
        rows = np.vstack([rows, [[length, 0, full, 0, 1, 0]]])
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("earlier"))
    ranked = cut.join(offsets, ["part", "length"]).withColumn("rank", F.col("earlier") + F.col("nth")).drop("earlier")
    key = rows[:, 0] << np.int64(48) | rows[:, 1]  # ranks stay below 2**48

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            row = rows[np.searchsorted(key, size << np.int64(48) | rank, "right") - 1]
            at = rank - row[:, 1]
            sequence, offset = row[:, 3] + at // row[:, 4], row[:, 5] + size * (at % row[:, 4])
            yield pa.record_batch([*(batch.column(c) for c in kept), pa.array(sequence), pa.array(offset)], names=[*kept, "sequence_id", "offset"])

    kept = [c for c in cut.columns if c not in ("part", "nth")]
    types = dict(cut.dtypes)
    schema = ", ".join([*(f"{c} {types[c]}" for c in kept), "sequence_id bigint", "offset bigint"])
    return map_batches(ranked, run, schema)


def _places(sizes: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence (from 0) and offset of pieces that are packed together."""
    counts = np.bincount(sizes, minlength=length + 1)
    full = int(counts[length])
    rows = plan(counts[:length], full)
    if full:
        rows = np.vstack([rows, [[length, 0, full, 0, 1, 0]]])
    order = np.argsort(sizes, kind="stable")
    rank = np.empty(len(sizes), np.int64)
    rank[order] = np.arange(len(sizes)) - (np.cumsum(counts) - counts)[sizes[order]]
    row = rows[np.searchsorted(rows[:, 0] << np.int64(48) | rows[:, 1], sizes << np.int64(48) | rank, "right") - 1]
    at = rank - row[:, 1]
    sequence = row[:, 3] + at // row[:, 4]
    shuffled = np.random.default_rng(seed).permutation(int(sequence.max()) + 1)
    return shuffled[sequence], row[:, 5] + sizes * (at % row[:, 4])


def pack_in_order(docs: DataFrame, weights=None, length: int = LENGTH, ranks: str | None = None, with_ids: bool = False) -> DataFrame:
    """:func:`pack` along the mix of ``docs`` by ``weights`` (see :func:`pfair.mix`).

    Only pieces are moved, not texts. Memory is that of the pieces of a range.
    """
    starts, runs = pfair.starts(docs, weights)
    cut = durable(pieces(docs, length, ranks, with_ids, mixed=True), "pieces")
    kept = [c for c in cut.columns if c not in ("part", "nth", "source", "place")]
    located = cut.withColumn("run", pfair.run_of(F.col("place"), runs)).join(starts, ["source", "run"])
    step = F.element_at(F.filter("steps", lambda x: x["place"] <= F.col("place")), -1)["step"]
    located = located.select(*kept, "place", F.floor(step / RANGE_BLOCKS).cast("long").alias("range"))
    names = [*kept, "range", "local", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def packed() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            sequence, offset = _places(table.column("length").to_numpy(), length, table.column("range")[0].as_py())
            table = table.append_column("local", pa.array(sequence)).append_column("offset", pa.array(offset))
            yield from table.select(names).combine_chunks().to_batches()

        for batch in batches:
            ranges = batch.column("range").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(ranges)) + 1).tolist(), len(ranges)]
            for a, b in zip(edges[:-1], edges[1:]):
                if a == b:
                    continue
                if held and held[0].column("range")[0].as_py() != ranges[a]:
                    yield from packed()
                    held.clear()
                held.append(batch.slice(a, b - a))
        if held:
            yield from packed()

    types = dict(located.dtypes)
    schema = ", ".join([*(f"{c} {types[c]}" for c in [*kept, "range"]), "local bigint", "offset bigint"])
    ordered = located.repartition("range").sortWithinPartitions("range", "place", "doc_id", "start")
    local = durable(map_batches(ordered, run, schema), "ranges")
    sizes = local.groupBy("range").agg((F.max("local") + 1).alias("n")).withColumn("group", F.floor(F.col("range") / RANGE_GROUP))
    # Running sums on two levels, so that no task orders all ranges.
    within = Window.partitionBy("group").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = sizes.groupBy("group").agg(F.sum("n").alias("n"))
    groups = groups.select("group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inner = sizes.select("range", "group", F.coalesce(F.sum("n").over(within), F.lit(0)).alias("base"))
    bases = inner.join(groups, "group").select("range", (F.col("first") + F.col("base")).alias("base"))
    return local.join(bases, "range").select(*kept, (F.col("base") + F.col("local")).alias("sequence_id"), "offset")
