"""Ranked lexical search that scores each class of equal documents once.

Documents are cut down to the terms that occur in items. What is left of one, the terms with
their numbers of occurrences and the length factor m, decides its score for every item, so
documents with the same rest form a class: they are dealt out by a hash of it, and the rest
itself is compared. A class is scored once; its members follow by ascending doc_id, and as no
item lists more than ``k`` documents, no class needs more than its ``k`` least members.

* The terms of all items reach the tasks as a bitmap of fixed size. A term that only shares a bit
  stays in the vector, where it may divide a class but has no weight.
* Items are scored in blocks of about ``POSTINGS`` distinct terms, dealt by a hash of the item.
  A block goes to all tasks, which read the classes once per block and keep ``k`` documents per
  item at a time.

Defined results: null and empty texts have no terms, count for nothing and are never listed; rows
that repeat a document are documents of their own, listed one after the other; a null doc_id
comes last among equals. Rows of one item_id (or of none) are one item with the terms of all its
distinct texts. Items without a known term get no rows, nor do empty tables. Extra columns do
not matter.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockrecon.llm.bitmaps import Members, bitmap, slices
from stockrecon.llm.common import durable, map_batches

#: Terms, on characters and on UTF-8 bytes (all bytes of other than ASCII are 0x80 and above).
TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_BREAK = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
#: 2**25 bits, 4 MB, tell which terms occur in items.
BITS = 25
#: Distinct (item, term) pairs that are sent to the tasks at a time.
POSTINGS = 1_000_000
#: Numbers in a dense part of the weights, and in an intermediate product.
CELLS, PRODUCTS = 4_000_000, 2_000_000
FOUND = "item_id long, doc_id long, score long"


def lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id``, ``term`` and ``asked``, how often the item holds it."""
    once = items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    found = F.regexp_extract_all(lower(F.col("text")), F.lit(TERM), F.lit(0))
    return once.select("item_id", F.explode(found).alias("term")).groupBy("item_id", "term").agg(
        F.count("*").alias("asked")
    )


def bags(docs: DataFrame, vocabulary: bytes, bits: int = BITS) -> DataFrame:
    """``doc_id``, ``n`` (all terms of the text), ``terms`` that items may hold, sorted, and their ``tfs``."""
    schema = "doc_id long, n long, terms array<string>, tfs array<long>"
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = Members(vocabulary, bits)
        for batch in batches:
            sizes, terms, tfs = [], [], []
            for text in batch.column("text"):
                size, counts = 0, Counter()
                for part in slices((text.as_py() or "").encode().lower(), _BREAK):
                    found = _TERM.findall(part)
                    size += len(found)
                    counts.update(found)
                kept = sorted(term for term in counts if wanted(term))
                sizes.append(size)
                terms.append([term.decode() for term in kept])
                tfs.append([counts[term] for term in kept])
            columns = [batch.column("doc_id"), *(pa.array(c, kind) for c, kind in zip((sizes, terms, tfs), kinds[1:]))]
            yield pa.record_batch(columns, names=["doc_id", "n", "terms", "tfs"])

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, schema)


def classes(found: DataFrame, documents: int, all_terms: int, k: int) -> DataFrame:
    """``m``, ``terms``, ``tfs`` and the ``k`` least ``members`` of each class with a term.

    Members beyond them are cut before the shuffle, so a class of a third of all documents is
    a few rows per task.
    """
    share = f"cast(25 * n AS DECIMAL(14,0)) * cast({documents} AS DECIMAL(20,0)) div cast({max(all_terms, 1)} AS DECIMAL(20,0))"
    vectors = found.where(F.size("terms") > 0).select(
        "doc_id", "terms", "tfs", F.expr(f"100 - 25 + ({share})").cast("long").alias("m")
    )
    key = ["hash", "m", "terms", "tfs"]
    hashed = vectors.withColumn("hash", F.xxhash64("m", "terms", "tfs"))
    least = F.row_number().over(Window.partitionBy(*key).orderBy(F.col("doc_id").asc_nulls_last()))
    members = F.transform(F.array_sort(F.collect_list(F.struct(F.col("doc_id").isNull(), "doc_id"))), lambda x: x["doc_id"])
    few = hashed.withColumn("place", least).where(F.col("place") <= k)
    return few.groupBy(*key).agg(members.alias("members")).drop("hash")


def _best(item: np.ndarray, score: np.ndarray, none: np.ndarray, doc: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best rows of each item, item by item, best first."""
    order = np.lexsort((doc, none, -score, item))
    sorted_item = item[order]
    starts = np.flatnonzero(np.r_[True, sorted_item[1:] != sorted_item[:-1]]) if len(order) else np.empty(0, int)
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return order[place < k]


def scorer(rows: pa.Table, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The best documents of a task's classes for a block of items; ``rows``: item_id, term, weight."""
    terms = pc.unique(rows.column("term"))
    ids = pc.unique(rows.column("item_id"))
    term_of = pc.index_in(rows.column("term"), terms).to_numpy().astype(np.int64)
    item_of = pc.index_in(rows.column("item_id"), ids).to_numpy().astype(np.int64)
    weight = rows.column("weight").to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = max(1, CELLS // max(len(terms), 1))
        floor = np.ones(len(ids), np.int64)  # what a further document has to reach
        best = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)]
        pending: list[list[np.ndarray]] = []

        def settle() -> None:
            nonlocal best
            best = [np.concatenate(parts) for parts in zip(best, *pending)]
            pending.clear()
            chosen = _best(*best, k)
            best = [part[chosen] for part in best]
            full = np.flatnonzero(np.bincount(best[0], minlength=len(ids)) >= k)
            last = np.searchsorted(best[0], full, "right") - 1
            floor[full] = best[1][last]

        dense: dict[int, np.ndarray] = {}

        def weights(first: int) -> np.ndarray:
            if first not in dense:
                if wide < len(ids):
                    dense.clear()  # one part at a time
                part = np.zeros((len(terms), min(wide, len(ids) - first)), np.int64)
                here = (item_of >= first) & (item_of < first + wide)
                part[term_of[here], item_of[here] - first] = weight[here]
                dense[first] = part
            return dense[first]

        for batch in batches:
            listed, tfs, members = (batch.column(c) for c in ("terms", "tfs", "members"))
            bounds = np.asarray(listed.offsets) - listed.offsets[0].as_py()
            column = pc.index_in(listed.flatten(), terms).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(len(batch)), np.diff(bounds))
            known = column >= 0
            m = batch.column("m").to_numpy()
            tf = tfs.flatten().to_numpy(zero_copy_only=False)
            value = (1_000_000_000 * tf[known]) // (1000 * tf[known] + 12 * m[owner[known]])
            column, owner = column[known], owner[known]
            member_of = np.asarray(members.offsets) - members.offsets[0].as_py()
            member = members.flatten()
            none = np.asarray(member.is_null())
            doc = member.fill_null(0).to_numpy(zero_copy_only=False)
            for first in range(0, len(ids), wide):
                part = weights(first)
                step = max(1, PRODUCTS // part.shape[1])
                at = 0
                while at < len(owner):  # whole classes, about ``step`` terms at a time
                    end = int(np.searchsorted(owner, owner[min(at + step, len(owner)) - 1], "right"))
                    starts = np.flatnonzero(np.r_[True, owner[at + 1 : end] != owner[at : end - 1]])
                    scores = np.add.reduceat(part[column[at:end]] * value[at:end, None], starts, axis=0)
                    row, item = np.nonzero(scores >= floor[first : first + part.shape[1]])
                    cls = owner[at:end][starts][row]
                    times = member_of[cls + 1] - member_of[cls]
                    begins = np.repeat(member_of[cls] - np.r_[0, np.cumsum(times)[:-1]], times) if len(cls) else times
                    place = begins + np.arange(times.sum())
                    pending.append([np.repeat(item + first, times), np.repeat(scores[row, item], times), none[place], doc[place]])
                    at = end
                    if sum(len(p[0]) for p in pending) > 4 * k * len(ids):
                        settle()
        settle()
        yield pa.record_batch(
            [ids.take(pa.array(best[0])), pa.array(best[3], mask=best[2]), pa.array(best[1])],
            names=["item_id", "doc_id", "score"],
        )

    return run


def search(items: DataFrame, docs: DataFrame, k: int = 20, bits: int = BITS, postings: int = POSTINGS) -> DataFrame:
    """The ``k`` best documents of each item: ``item_id``, ``rank``, ``doc_id`` and ``score``."""
    asked = durable(item_terms(items), "asked")
    found = durable(bags(docs, bitmap(asked.select("term").distinct(), F.crc32("term"), bits), bits), "bags")
    documents, all_terms = found.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * documents + 2) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    block = F.pmod(F.xxhash64("item_id"), F.lit(-(-asked.count() // postings) or 1)).cast("int")
    weighed = durable(
        asked.join(holding, "term").select("item_id", "term", (weight * F.col("asked")).alias("weight"), block.alias("block")),
        "weighed",
    )
    merged = durable(classes(found, documents, all_terms, k), "classes")
    best = [merged.sparkSession.createDataFrame([], FOUND)]
    for row in weighed.select("block").distinct().sort("block").toLocalIterator():
        part = weighed.where(F.col("block") == row["block"]).select("item_id", "term", "weight").toArrow()
        best.append(durable(map_batches(merged, scorer(part, k), FOUND), "best"))
    by_score = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = reduce(DataFrame.unionByName, best).withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
