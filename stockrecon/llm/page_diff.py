"""Main text of pages by differencing each page with the page of its host whose URL is nearest.

Pages are put in the order of host and path, and each is compared with the neighbour, before or
after it, that shares the longer beginning of its path. Their lines are aligned by a longest
common subsequence, and lines both pages have are deleted as belonging to the site.

Differencing alone cannot give the article: menus and adverts differ between neighbours too,
copies of an article share every line, and articles of a site quote the same lines. So elements
that mark themselves as no part of an article are left out first. Every page is then differenced,
by all its other lines. On a page that marks an article, lines beside the article go, and the
article's paragraphs, headings, lists, quotations and tables stay, shared or not; differencing decides
on the rest of the article, as on all lines of a page that marks none. Pages whose whole line
sequences are equal or nearly so are copies, which say nothing about the site: the next nearest page
by URL takes their place, until one is no copy or the host ends, and then nothing is deleted.

Only hashes of lines are compared and shuffled. Neighbours are found by a range partitioning, a
number for each run of equal pages and equality joins on the number, so a host of any size is spread
out. Each round goes one page further for the pages that have met copies only; a run of equal pages
is one step.

Defined results: null pages are empty and have an empty text; null URLs form a host of their own
('', with an empty path); pages with equal URLs are ordered by page_id, then by text; repeated
rows are copies of each other; extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stockrecon.llm.common import durable, map_batches
from stockrecon.llm.page_lines import MAY_GO, OUTSIDE, parts

#: Pages that share this part of the lines of the longer one, in order, are copies.
COPY_SHARE = 0.9


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Positions in ``a`` of a longest common subsequence of ``a`` and ``b``, the earliest ones.

    Equal beginnings and ends are taken off first. Rows of the table are bit sets, one bit per
    line of ``b``, so a page of many lines takes few steps and little memory.
    """
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    middle, other = a[head : len(a) - tail], b[head : len(b) - tail]
    found = list(range(head))
    if middle and other:
        where: dict[int, int] = {}
        for j, line in enumerate(other):
            where[line] = where.get(line, 0) | 1 << j
        full = (1 << len(other)) - 1
        rows, row = [], full
        for line in middle:
            rows.append(row)
            hits = row & where.get(line, 0)
            row = ((row + hits) | (row - hits)) & full
        # A cleared bit j in a row: one more line matches once b is read up to j.
        taken, j = [], len(other)
        rows.append(row)

        def length(i: int, upto: int) -> int:
            return upto - (rows[i] & ((1 << upto) - 1)).bit_count()

        i = len(middle)
        while i and j and length(i, j):
            if length(i - 1, j) == length(i, j):
                i -= 1
            elif length(i, j - 1) == length(i, j):
                j -= 1
            else:
                i, j = i - 1, j - 1
                taken.append(head + i)
        found += reversed(taken)
    return found + list(range(len(a) - tail, len(a)))


def _shared_prefix(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def page_lines(pages: DataFrame) -> DataFrame:
    """``row``, ``page_id``, ``url``, ``host``, ``path``, ``fates``, ``lines`` and ``hashes``."""
    schema = "row long, page_id long, url string, host string, path string, fates array<tinyint>, lines array<string>, hashes array<long>"
    names = ["row", "page_id", "url", "host", "path"]
    out = pa.schema(
        [("row", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("path", pa.string())]
        + [("fates", pa.list_(pa.int8())), ("lines", pa.list_(pa.string())), ("hashes", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), 256):
                rows = batch.slice(first, 256)
                read = [parts(page or "") for page in rows.column("html").to_pylist()]
                found, fates = [page for page, _, _ in read], [fate for _, fate, _ in read]
                hashes = [[xxhash.xxh64_intdigest(x) - (1 << 63) for x in page] for page in found]
                made = [pa.array(x, out.field(n).type) for n, x in (("fates", fates), ("lines", found), ("hashes", hashes))]
                yield pa.record_batch([*(rows.column(c).cast(out.field(c).type) for c in names), *made], schema=out)

    url = F.coalesce("url", F.lit(""))
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        F.lower(F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(url, r"^(?s).*?://[^/?#]*(.*)$", 1).alias("path"),
        "html",
    )
    return map_batches(rows, run, schema)


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``number``: pages of equal lines that follow each other in a host have the same one.

    Numbers are in order, from 0 on without gaps; a run may be cut at the edge of a partition.
    """
    schema = ", ".join([*(f"`{c}` {t}" for c, t in rows.dtypes), "part int", "nth long"])
    names = [*rows.columns, "part", "nth"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, last = TaskContext.get().partitionId(), -1, None
        for batch in batches:
            nth = []
            for page in zip(batch.column("host").to_pylist(), batch.column("hashes").to_pylist()):
                seen, last = seen + (page != last), page
                nth.append(seen)
            yield pa.record_batch([*batch.columns, pa.array(np.full(len(batch), part, np.int32)), pa.array(nth, pa.int64())], names=names)

    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = durable(map_batches(ordered, run, schema), "in-order")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition.
    starts = placed.groupBy("part").agg((F.max("nth") + 1).alias("n"))
    starts = starts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    return placed.join(F.broadcast(starts), "part").select(*rows.columns, (F.col("start") + F.col("nth")).alias("number"))


def site_lines(parsed: DataFrame) -> DataFrame:
    """``row`` and ``deleted``, the positions of lines shared with the nearest page by URL that is no copy."""
    light = parsed.select("host", "path", "page_id", "hashes", "row")
    placed = durable(numbered(light, ["host", "path", "page_id", "hashes"]), "url-order")
    runs = placed.groupBy("number").agg(
        F.first("host").alias("host"), F.min("path").alias("least"), F.max("path").alias("last"), F.first("hashes").alias("hashes")
    )

    def beside(pointer: str, path: str, name: str) -> DataFrame:
        return runs.select(F.col("number").alias(pointer), F.struct("host", F.col(path).alias("path"), "hashes").alias(name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                near = [n for n in ("left", "right") if row[n]]
                if not near:
                    continue
                side = max(near, key=lambda n: _shared_prefix(row["path"], row[n]["path"]))
                mine, other = row["hashes"], row[side]["hashes"]
                shared = common_lines(mine, other)
                if len(shared) >= COPY_SHARE * max(len(mine), len(other)):
                    pointers = (row["before"] - (side == "left"), row["after"] + (side == "right"))
                    out.append((row["row"], row["host"], row["path"], mine, *pointers, None))
                elif shared:
                    out.append((row["row"], None, None, None, None, None, shared))
            columns = list(zip(*out)) or [()] * len(kinds)
            yield pa.record_batch([pa.array(c, t) for c, (_, t) in zip(columns, kinds)], schema=pa.schema(kinds))

    schema = "row long, host string, path string, hashes array<long>, before long, after long, deleted array<long>"
    whole = pa.list_(pa.int64())
    kinds = [("row", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("hashes", whole)]
    kinds += [("before", pa.int64()), ("after", pa.int64()), ("deleted", whole)]
    number = F.col("number")
    open_ = placed.where(F.size("hashes") > 0)
    open_ = open_.select("row", "host", "path", "hashes", (number - 1).alias("before"), (number + 1).alias("after"))
    found = parsed.select("row", F.lit(None).cast("array<long>").alias("deleted")).limit(0)
    while not open_.isEmpty():
        both = open_.join(beside("before", "last", "left"), "before", "left").join(beside("after", "least", "right"), "after", "left")
        in_host = [F.when(F.col(n)["host"] == F.col("host"), F.col(n)).alias(n) for n in ("left", "right")]
        judged = durable(map_batches(both.select("row", "host", "path", "hashes", "before", "after", *in_host), run, schema), "judged")
        found = found.unionByName(judged.where(F.col("deleted").isNotNull()).select("row", "deleted"))
        open_ = judged.where(F.col("deleted").isNull()).drop("deleted")
    return found


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: ``page_id``, ``url``, ``text`` and ``n_chars``."""
    parsed = durable(page_lines(pages), "page-lines")
    gone = durable(site_lines(parsed), "site-lines")

    def fated(positions: Column, test: Callable[[Column], Column]) -> Column:
        return F.filter(positions, lambda i: test(F.get("fates", i.cast("int"))))

    none = F.array().cast("array<long>")
    places = F.when(F.size("lines") > 0, F.sequence(F.lit(0).cast("long"), F.size("lines").cast("long") - 1)).otherwise(none)
    gone_here = fated(F.coalesce("deleted", none), lambda fate: fate == MAY_GO)
    kept = F.array_except(fated(places, lambda fate: fate != OUTSIDE), gone_here)
    kept = F.transform(kept, lambda i: F.get("lines", i.cast("int")))
    text = F.array_join(kept, " ")
    return parsed.join(gone, "row", "left").select(
        "page_id", "url", text.alias("text"), F.char_length(text).cast("long").alias("n_chars")
    )
