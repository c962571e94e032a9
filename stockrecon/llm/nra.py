"""Exact top-k by inner product, by No-Random-Access aggregation over sorted lists.

Vectors are held in blocks. A block keeps one list per dimension, its rows sorted by their
component; for a query the list is read from its large end where the query's component is
positive and from its small end where it is negative, so that contributions only fall. All
queries of a block of queries read the lists of a block of candidates in step. A row's lower
bound adds, to the contributions seen, the worst that its unread lists hold, its upper bound the
last contribution read from them. Reading goes on until, for each query, all but a few rows have
an upper bound below the k-th best lower bound; the scores of those few are then resolved. The
best of all blocks are the result.

Every pair of a query block and a candidate block is one row of an equality join, so work is
spread over tasks of equal size, and no table is broadcast.

Defined results: a vector that is null or holds null or non-finite components takes no part, nor
does a row without id; rows that repeat an id count once, with the least vector; a missing
component of a shorter vector counts 0; equal scores go to the smaller id; with fewer candidates
than k all are returned; scores must fit in a long; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stockrecon.llm.common import durable, map_batches

#: Rows of a block of candidates and of a block of queries.
CANDIDATES, QUERIES = 8_192, 1_024
#: Parts of the lists read before bounds are compared anew.
DEPTHS = (0.125, 0.25, 0.5, 1.0)
#: A query stops reading when at most this many times k rows can still qualify.
FEW = 8
BLOCK = "block long, n int, width int, ids binary, rows binary"


def usable(vector: Column) -> Column:
    """True for vectors without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def blocks(vectors: DataFrame, size: int) -> DataFrame:
    """Rows of ``id`` and ``vector`` (array of longs) packed into blocks of at most ``size``."""
    names = ["block", "n", "width", "ids", "rows"]

    def packed(number: int, ids: list[int], rows: list[np.ndarray]) -> pa.RecordBatch:
        width = max(map(len, rows))
        matrix = np.zeros((len(rows), width), np.int64)
        for i, row in enumerate(rows):
            matrix[i, : len(row)] = row
        columns = [[number], [len(ids)], [width], [np.array(ids, np.int64).tobytes()], [_narrow(matrix).tobytes()]]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made = TaskContext.get().partitionId() << 33, 0
        ids: list[int] = []
        rows: list[np.ndarray] = []
        for batch in batches:
            for i, row in zip(batch.column("id").to_pylist(), batch.column("vector")):
                ids.append(i)
                rows.append(row.values.to_numpy(zero_copy_only=False))
                if len(ids) == size:
                    yield packed(first + made, ids, rows)
                    ids, rows, made = [], [], made + 1
        if ids:
            yield packed(first + made, ids, rows)

    return map_batches(vectors, run, BLOCK)


def _narrow(matrix: np.ndarray) -> np.ndarray:
    """The smallest of 16, 32 and 64 bit integers that holds the values."""
    top = int(np.abs(matrix).max(initial=0))
    return matrix.astype(np.int16 if top < 1 << 15 else np.int32 if top < 1 << 31 else np.int64)


def _wide(ids: bytes, rows: bytes, n: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    kind = {2: np.int16, 4: np.int32, 8: np.int64}[len(rows) // (n * width)] if width else np.int16
    return np.frombuffer(ids, np.int64), np.frombuffer(rows, kind).reshape(n, width).astype(np.int64)


class Lists:
    """The sorted lists of a block of candidates."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.order = np.argsort(rows, axis=0, kind="stable")
        self.sorted = np.take_along_axis(rows, self.order, axis=0)

    def seen(self, depth: int, kind: type) -> tuple[np.ndarray, np.ndarray]:
        """After reading ``depth`` entries from both ends: the matrices of lower and of upper bounds.

        Columns are the lists from the large end, then the lists from the small end. What was
        read is in both at its value; the rest is, for positive factors, at the list's end in
        the lower and at the last entry read in the upper, and the other way round for negative ones.
        """
        n, width = self.rows.shape
        low, high = np.empty((n, 2 * width), kind), np.empty((n, 2 * width), kind)
        low[:, :width], high[:, :width] = self.sorted[0], self.sorted[n - depth]
        low[:, width:], high[:, width:] = self.sorted[n - 1], self.sorted[depth - 1]
        for columns, part in ((slice(0, width), slice(n - depth, n)), (slice(width, 2 * width), slice(0, depth))):
            for bound in (low, high):
                np.put_along_axis(bound[:, columns], self.order[part], self.sorted[part].astype(kind), axis=0)
        return low, high


def top_k(lists: Lists, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its number, and the ids and scores of the rows that can be among its k best."""
    n, width = lists.rows.shape
    top = max(1, width) * int(np.abs(lists.rows).max(initial=0)) * int(np.abs(queries).max(initial=0))
    kind = np.float32 if top < 1 << 23 else np.float64 if top < 1 << 52 else None  # sums are exact in it
    waiting = np.arange(len(queries))
    few = FEW * k
    for depth in [] if kind is None else DEPTHS:
        if not len(waiting) or n <= few:
            break
        read = max(1, min(n, int(np.ceil(n * depth))))
        low, high = lists.seen(read, kind)
        q = queries[waiting]
        factors = np.concatenate([np.maximum(q, 0), np.minimum(q, 0)], axis=1).astype(kind).T
        at_least, at_most = low @ factors, high @ factors
        self_ = ids[:, None] == own[waiting][None, :]
        at_least[self_] = at_most[self_] = -np.inf
        # With at most k - 1 other rows in the block the bound is -inf and all rows stay.
        bound = np.partition(at_least, n - k, axis=0)[n - k]
        open_ = at_most >= bound
        count = open_.sum(axis=0)
        done = (count <= few) | (read == n)
        for column in np.flatnonzero(done):
            rows = np.flatnonzero(open_[:, column] & ~self_[:, column])
            number = int(waiting[column])
            yield number, ids[rows], lists.rows[rows] @ queries[number]
        waiting = waiting[~done]
    for number in waiting.tolist():
        rows = np.flatnonzero(ids != own[number])
        yield number, ids[rows], lists.rows[rows] @ queries[number]


def search(queries: DataFrame, candidates: DataFrame, k: int = 5) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of the k best candidates of each query.

    Both inputs have ``id`` and ``vector`` (array of longs). A candidate with the id of the
    query is the query's own row and no candidate.
    """
    c = durable(blocks(candidates, CANDIDATES), "candidate-blocks")
    q = durable(blocks(queries.repartition(max(1, -(-queries.count() // QUERIES))), QUERIES), "query-blocks")
    # Every candidate block meets every query block in one cell of a grid: each is sent to all
    # cells of its row or column.
    down, across = max(1, c.count()), max(1, q.count())
    row, column = (F.pmod(F.xxhash64("block"), F.lit(n)) for n in (down, across))
    cells = ["row", "column"]
    pairs = c.select(
        *(F.col(n).alias(f"c_{n}") for n in c.columns), row.alias("row"), F.explode(_up_to(across)).alias("column")
    ).join(
        q.select(*(F.col(n).alias(f"q_{n}") for n in q.columns), column.alias("column"), F.explode(_up_to(down)).alias("row")),
        cells,
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                ids, rows = _wide(row["c_ids"], row["c_rows"], row["c_n"], row["c_width"])
                own, asked = _wide(row["q_ids"], row["q_rows"], row["q_n"], row["q_width"])
                width = min(rows.shape[1], asked.shape[1])  # beyond it one of the two is 0
                found = [
                    (int(own[number]), near[best], scores[best])
                    for number, near, scores in top_k(Lists(rows[:, :width]), ids, asked[:, :width], own, k)
                    for best in (np.lexsort((near, -scores))[:k],)
                ]
                counts = [len(near) for _, near, _ in found]
                yield pa.record_batch(
                    [
                        pa.array(np.repeat(np.array([o for o, _, _ in found], np.int64), counts)),
                        pa.array(np.concatenate([x for _, x, _ in found] or [np.empty(0, np.int64)])),
                        pa.array(np.concatenate([x for _, _, x in found] or [np.empty(0, np.int64)])),
                    ],
                    names=["query_id", "vec_id", "score"],
                )

    best = map_batches(pairs, run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _up_to(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def quantised(vectors: DataFrame, id_: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """``id`` and ``vector`` of the rows that take part, components as floor(scale * x)."""
    whole = F.transform(F.col(vector), lambda x: F.floor(scale * x.cast("double")).cast("long"))
    rows = vectors.where(F.col(id_).isNotNull() & usable(F.col(vector)))
    return rows.select(F.col(id_).cast("long").alias("id"), whole.alias("vector")).groupBy("id").agg(F.min("vector").alias("vector"))
