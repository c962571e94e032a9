"""Near-duplicate documents by SuperMinHash signatures.

Every shingle of a document takes the positions of the signature in an order of its own, a
random permutation drawn step by step, and offers the position it takes in step j a value in
[j, j + 1). A position keeps its least offer. Since a step never beats an earlier one, the
steps are run for all shingles side by side and stop as soon as every position is taken, which
for long documents is after a few of them.

Signatures are cut into bands; documents that agree in a band are candidates. Candidates are
tied to the least document of their bucket, the connected candidates form groups, and each
group's full shingle sets are compared within buckets, skipping pairs already known to be
connected. Two documents at exactly the threshold of 0.8 miss each other in all 40 bands of 5
with a probability of 1.3e-7; more similar ones less often.

Copies with equal shingle sets are one node throughout. A group of candidates beyond
``GROUP_NODES`` is compared block against block, each pair of blocks a task of its own.

Texts of candidates are fetched, and rows that go are found, behind a bitmap of fixed size over
the names of the wanted rows, so the other texts are never shuffled.

Defined results: null, empty and blank texts have no shingles and are linked with nothing;
repeated rows are copies of each other; a component without any doc_id has a null component_id,
and documents without doc_id are kept only there; extra columns do not matter. ``keep_one`` judges
rows, not ids: different texts under one doc_id or none are judged each, the row of the least
doc_id (no id last) stays, rows without shingles stay all, and of rows that repeat doc_id and text
one stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockrecon.llm.common import durable, fresh, map_batches
from stockrecon.llm.components import components
from stockrecon.llm.hashing import GOLDEN, mix, shingle_sets
from stockrecon.operators.prefilter import hash_set, may_be_in

BANDS, ROWS = 40, 5
POSITIONS = BANDS * ROWS
#: Shingles signed at a time, documents signed at a time.
CHUNK, CHUNK_DOCS = 65_536, 512
#: Nodes and shingles of a block of a large group.
GROUP_NODES, GROUP_SHINGLES = 1_000, 4_000_000
FREE = np.uint32(0xFFFFFFFF)


def _sign(shingles: np.ndarray, owner: np.ndarray, documents: int) -> np.ndarray:
    """Signatures of some documents; the step is in the upper 8 bits, the fraction below."""
    values = np.full(documents * POSITIONS, FREE, np.uint32)
    order = None  # the permutations, once a second step is needed
    base, drawn = owner.astype(np.int64) * POSITIONS, None
    for j in range(POSITIONS):
        r = mix(shingles + np.uint64((2 * j + 1) * int(GOLDEN) & 0xFFFFFFFFFFFFFFFF))
        k = j + ((r >> np.uint64(32)) * np.uint64(POSITIONS - j) >> np.uint64(32)).astype(np.int64)
        if j == 0:
            taken = drawn = k
        else:
            rows = np.arange(len(shingles))
            if order is None:
                order = np.tile(np.arange(POSITIONS, dtype=np.uint8), (len(shingles), 1))
                order[rows, drawn] = 0
            taken = order[rows, k].astype(np.int64)
            order[rows, k] = order[:, j]
        offer = np.uint32(j << 24) | (r & np.uint64(0xFFFFFF)).astype(np.uint32)
        place = base + taken
        open_ = values[place] == FREE
        np.minimum.at(values, place[open_], offer[open_])
        unfinished = (values.reshape(documents, POSITIONS) == FREE).any(axis=1)
        if not unfinished.any():
            break
        stay = unfinished[base // POSITIONS]
        if not stay.all():
            shingles, base, drawn = shingles[stay], base[stay], drawn[stay]
            order = order if order is None else order[stay]
    return values.reshape(documents, POSITIONS)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row per set. Sets must not be empty; sets beyond a chunk are signed in parts."""
    result = np.full((len(sets), POSITIONS), FREE, np.uint32)
    first = 0
    while first < len(sets):
        last, size = first, 0
        while last < len(sets) and last - first < CHUNK_DOCS and (last == first or size + len(sets[last]) <= CHUNK):
            size += len(sets[last])
            last += 1
        owner = np.repeat(np.arange(last - first), [len(s) for s in sets[first:last]])
        flat = np.concatenate(sets[first:last])
        for part in range(0, len(flat), CHUNK):
            signed = _sign(flat[part : part + CHUNK], owner[part : part + CHUNK], last - first)
            np.minimum(result[first:last], signed, out=result[first:last])
        first = last
    return result


def bands(signed: np.ndarray) -> np.ndarray:
    """One hash per band; the band's number is part of it."""
    parts = signed.reshape(len(signed), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(mix(np.arange(BANDS, dtype=np.uint64)), (len(signed), BANDS))
    for c in range(ROWS):
        key = mix(key ^ parts[:, :, c])
    return key.view(np.int64)


def _key(shingles: np.ndarray) -> bytes:
    """128 bits that name a set."""
    halves = (mix(shingles).sum(dtype=np.uint64), mix(~shingles).sum(dtype=np.uint64))
    return b"".join(int(h).to_bytes(8, "big") for h in halves)


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_shingles``, ``key`` and ``bands`` (both null without shingles)."""
    schema = "doc_id long, text_hash long, n_shingles long, key binary, bands array<long>"
    kinds = [
        ("doc_id", pa.int64()),
        ("text_hash", pa.int64()),
        ("n_shingles", pa.int64()),
        ("key", pa.binary()),
        ("bands", pa.list_(pa.int64())),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in shingle_sets(batch.column("text"), size):
                full = [i for i, s in enumerate(sets) if len(s)]
                keyed, banded = [None] * len(sets), [None] * len(sets)
                if full:
                    for i, row in zip(full, bands(signatures([sets[i] for i in full]))):
                        keyed[i], banded[i] = _key(sets[i]), row
                rows = batch.slice(first, len(sets))
                counts = [len(s) for s in sets]
                made = [pa.array(c, kind) for c, (_, kind) in zip((counts, keyed, banded), kinds[2:])]
                columns = [rows.column("doc_id"), rows.column("text_hash"), *made]
                yield pa.record_batch(columns, schema=pa.schema(kinds))

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text"), F.xxhash64("text").alias("text_hash"))
    return map_batches(rows, run, schema)


def _connected(sets: list[np.ndarray], banded: np.ndarray, per_cent: int) -> list[int]:
    """For each set the first set it is connected with, over pairs that share a band."""
    parent = list(range(len(sets)))
    tried: set[tuple[int, int]] = set()

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    def similar(x: int, y: int) -> bool:
        a, b = sets[x], sets[y]
        if 100 * min(len(a), len(b)) < per_cent * max(len(a), len(b)):
            return False
        shared = np.intersect1d(a, b, assume_unique=True).size
        return 100 * shared >= per_cent * (len(a) + len(b) - shared)

    for band in range(banded.shape[1]):
        column = banded[:, band]
        order = np.argsort(column, kind="stable")
        edges = np.flatnonzero(np.diff(column[order])) + 1
        for bucket in np.split(order, edges):
            rest = bucket.tolist()
            while len(rest) > 1:
                lead, rest = rest[0], rest[1:]
                apart = [x for x in rest if root(x) != root(lead)]
                if not apart:
                    break
                for x in apart:
                    pair = (min(lead, x), max(lead, x))
                    if pair in tried or root(x) == root(lead):
                        continue
                    tried.add(pair)
                    if similar(lead, x):
                        low, high = sorted((root(lead), root(x)))
                        parent[high] = low
    return [root(x) for x in range(len(sets))]


def _links(candidates: DataFrame, size: int, per_cent: int) -> DataFrame:
    """``a`` and ``b``, keys of connected nodes. Rows: task (sorted within partitions), key, text."""

    def of_task(keys: list[bytes], texts: list) -> Iterator[tuple[bytes, bytes]]:
        unique = dict(zip(keys, texts))
        sets = [s for _, found in shingle_sets(pa.array(unique.values(), pa.large_string()), size) for s in found]
        known = [(k, s) for k, s in zip(unique, sets) if len(s) and _key(s) == k]
        if len(known) > 1:
            sets = [s for _, s in known]
            for i, r in enumerate(_connected(sets, bands(signatures(sets)), per_cent)):
                if i != r:
                    yield known[i][0], known[r][0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, keys, texts = None, [], []
        found: list[tuple[bytes, bytes]] = []
        for batch in batches:
            for t, k, x in zip(*(batch.column(c).to_pylist() for c in ("task", "key", "text"))):
                if t != task:
                    found += of_task(keys, texts)
                    task, keys, texts = t, [], []
                keys.append(k)
                texts.append(x)
        found += of_task(keys, texts)
        yield pa.record_batch([pa.array([f[i] for f in found], pa.binary()) for i in (0, 1)], names=["a", "b"])

    return map_batches(candidates, run, "a binary, b binary")


def _row_name(doc_id: str | Column = "doc_id", text_hash: str | Column = "text_hash") -> Column:
    return F.xxhash64(doc_id, text_hash)


def _judged(docs: DataFrame, size: int, per_cent: int) -> DataFrame:
    """Every row as ``doc_id``, ``text_hash``, ``n_shingles``, ``key``, ``component`` (its least doc_id) and ``pick``.

    The pick names the row that stays for the component: ``none`` (no id), ``doc_id`` and
    ``text_hash``. Rows without shingles have neither key nor pick.
    """
    sketched = durable(sketches(docs, size), "sketches")
    nodes = durable(
        sketched.where(F.col("key").isNotNull())
        .groupBy("key")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("pick"),
            F.first("bands").alias("bands"),
            F.first("n_shingles").alias("n_shingles"),
        )
        .withColumn("short", F.xxhash64("key")),
        "nodes",
    )
    # Buckets and groups of candidates name a node by half of its key, which keeps their many
    # rows short; two nodes that shared it would only be compared once more.
    slots = nodes.select(F.explode("bands").alias("bucket"), "short")
    leaders = slots.groupBy("bucket").agg(F.min("short").alias("leader"), F.max("short").alias("last"))
    leaders = leaders.where("leader != last").drop("last")
    ties = slots.join(leaders, "bucket").where("short != leader").select("leader", "short")
    shorts = durable(components(ties).select(F.col("node").alias("short"), F.col("root").alias("group")), "candidates")
    grouped = durable(nodes.select("key", "short", "n_shingles", "pick").join(shorts, "short").drop("short"), "grouped")
    sizes = (
        grouped.groupBy("group")
        .agg(
            F.greatest(
                F.ceil(F.count("*") / (2 * GROUP_NODES)), F.ceil(F.sum("n_shingles") / (2 * GROUP_SHINGLES))
            ).alias("half")
        )
        .select("group", F.when(F.col("half") > 1, 2 * F.col("half")).otherwise(1).cast("int").alias("blocks"))
    )
    block = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    wanted = (
        grouped.join(sizes, "group")
        .select("group", "key", "pick", "blocks", block.alias("block"), F.explode(others).alias("other"))
        .where((F.col("block") != F.col("other")) | (F.col("blocks") == 1))
        .select(
            F.struct("group", F.least("block", "other"), F.greatest("block", "other")).alias("task"),
            "key",
            F.col("pick.doc_id").alias("pick_id"),
            F.col("pick.text_hash").alias("pick_hash"),
        )
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    texts = may_be_in(texts, hash_set(grouped, _row_name("pick.doc_id", "pick.text_hash")), _row_name())
    same = F.col("doc_id").eqNullSafe(F.col("pick_id")) & (F.col("text_hash") == F.col("pick_hash"))
    fetched = wanted.join(texts, same).select(F.to_json("task").alias("task"), "key", "text")
    found = durable(
        _links(fetched.repartition("task").sortWithinPartitions("task"), size, per_cent), "links"
    )
    labels = components(found).select(F.col("node").alias("key"), "root")
    rooted = nodes.select("key", "pick").join(labels, "key", "left").withColumn("root", F.coalesce("root", "key"))
    rooted = durable(rooted, "rooted")
    named = rooted.join(rooted.groupBy("root").agg(F.min("pick").alias("least")), "root").select("key", "least")
    return sketched.select("doc_id", "text_hash", "n_shingles", "key").join(named, "key", "left").select(
        "doc_id", "text_hash", "n_shingles", "key", F.col("least.doc_id").alias("component"), F.col("least").alias("pick")
    )


def components_of(docs: DataFrame, size: int = 5, per_cent: int = 80) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``."""
    own = F.col("doc_id")
    component = F.when(F.col("key").isNull(), own).otherwise(F.col("component"))
    return _judged(docs, size, per_cent).select(
        "doc_id", "n_shingles", component.alias("component_id"), own.eqNullSafe(component).alias("kept")
    )


def keep_one(docs: DataFrame, size: int = 5, per_cent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay, one per component, with the columns they came with.

    Rows that go, and rows that stay but are repeated, are named by doc_id and a hash of the text.
    A bitmap of their names lets all other rows pass as they are read.
    """
    judged = durable(
        _judged(docs, size, per_cent).where(F.col("key").isNotNull()).select("doc_id", "text_hash", "pick"), "judged"
    )
    stays = F.col("doc_id").eqNullSafe(F.col("pick.doc_id")) & (F.col("text_hash") == F.col("pick.text_hash"))
    named = judged.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n"), F.first(stays).alias("stays"))
    named = durable(named.where("n > 1 OR NOT stays"), "named")
    id_, hash_, n = fresh(docs, "named_id"), fresh(docs, "named_hash"), fresh(docs, "named_rows")
    text_hash, whole_id = F.xxhash64("text"), F.col("doc_id").cast("long")
    row = _row_name(whole_id, text_hash)
    names = hash_set(named, _row_name())
    listed = named.select(
        F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_), F.when(F.col("stays"), F.col("n")).alias(n)
    )
    same = whole_id.eqNullSafe(F.col(id_)) & (text_hash == F.col(hash_))
    suspects = may_be_in(docs, names, row)
    unnamed = suspects.join(listed, same, "left_anti")
    repeated = suspects.join(listed.where(F.col(n).isNotNull()), same).dropDuplicates([id_, hash_]).select(*docs.columns)
    return may_be_in(docs, names, row, how="left_anti").unionByName(unnamed).unionByName(repeated)
