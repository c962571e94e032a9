"""Scores of whole documents under a gated recurrent language model trained on the corpus.

Every training token is counted. The most frequent words are in classes with a softmax of
their own; every other word falls into an open class by its ending, and its share of the class
is its smoothed count there, so every word, unknown ones included, has a probability. The
network predicts the class from the state, and the word within closed classes.

Training is data-parallel: the training documents are dealt to rounds by hash and to shards, each
shard runs truncated backpropagation through time over successive windows of ``WINDOW`` tokens of
every whole document, from the same weights, and the weights are averaged, pairwise in groups on
the executors. Training and scoring both carry the state from window to window to the end.

Counts of the ``KNOWN`` most frequent words go along with the network; counts of rarer words are
joined, one row per document and word, so the vocabulary may grow without bound.

Defined results: null, empty and blank texts consist of the end token; a null doc_id is held
out; repeated rows are counted and scored each; without training documents both scores follow
from their formulas with no counts; extra columns do not matter.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockrecon.llm import gru
from stockrecon.llm.common import durable, map_batches

#: Words with a place in the network, words per class, open classes, state size.
CLOSED, PER_CLASS, OPEN, HIDDEN = 4_096, 64, 64, 32
#: Most frequent words whose counts every task holds.
KNOWN = 200_000
#: Tokens of a window; tokens of a shard; rounds of averaging, one pass in all.
WINDOW, SHARD, ROUNDS = 96, 3_000_000, 2
TRAIN_LANES, LANES, STEPS, RATE = 128, 256, 64, 0.02
#: Additive smoothing of counts; every tenth document (by hash) is held out.
SMOOTH, FOLDS = 0.1, 10
#: Distinct words a counting task holds before it passes them on.
FLUSH = 300_000
#: Weights that are added up in one task.
FAN_IN = 8
END = b""


def words_of(text: str | None) -> list[bytes]:
    """Words, A-Z lower-cased, and the end. The separators are those of ``bytes.split``."""
    found = (text or "").encode().lower().split()
    found.append(END)
    return found


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def counts(docs: DataFrame) -> DataFrame:
    """``word`` (the end as '') and ``n`` over the training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column("text"):
                seen.update(words_of(text.as_py()))
                if len(seen) > FLUSH:
                    yield of(seen)
                    seen.clear()
        yield of(seen)

    def of(seen: Counter[bytes]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(seen.keys(), pa.binary()).cast(pa.string()), pa.array(seen.values(), pa.int64())], names=["word", "n"])

    return map_batches(docs.select("text"), run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def open_class(word: Column) -> Column:
    return (F.crc32(F.substring(word.cast("binary"), -2, 2)) % OPEN).cast("int")


class Vocabulary:
    """Counts of the known words, the totals, and the network ids of words."""

    def __init__(self, known: list[tuple[str, int]], total: int, distinct: int, rest: dict[int, tuple[int, int]]):
        """``known``: words by falling count. ``rest``: tokens and words of each open class."""
        self.words = [w.encode() for w, _ in known]
        self.total, self.distinct = total, distinct
        n_words = min(CLOSED, len(known))
        self.layout = gru.Layout(n_words, PER_CLASS, OPEN)
        self.counts = np.array([n for _, n in known], float)
        classes = [zlib.crc32(w[-2:]) % OPEN for w in self.words[n_words:]]
        self.net = np.array([*range(n_words), *(n_words + c for c in classes)], np.int64)
        self.tokens = np.array([rest.get(c, (0, 0))[0] for c in range(OPEN)], float)
        # Natural logarithm of the sum that smoothed counts of a class add up to.
        self.open_log = np.log(self.tokens + SMOOTH * (np.array([rest.get(c, (0, 0))[1] for c in range(OPEN)]) + 1))
        self.log10 = np.log10(self.counts + SMOOTH)
        self.base_log10 = np.log10(total + SMOOTH * (distinct + 1))
        self._index: dict[bytes, int] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_index": None}

    def ranks(self, words: list[bytes]) -> list[int]:
        """Rank of each word among the known, or -1."""
        if self._index is None:
            self._index = {w: i for i, w in enumerate(self.words)}
        get = self._index.get
        return [get(w, -1) for w in words]

    def ids(self, words: list[bytes], ranks: np.ndarray) -> np.ndarray:
        """Network ids."""
        if not len(self.net):
            ids = np.zeros(len(words), np.int64)
        else:
            ids = self.net[ranks]
        for i in np.flatnonzero(ranks < 0).tolist():
            ids[i] = self.layout.n_words + zlib.crc32(words[i][-2:]) % OPEN
        return ids

    def network(self) -> gru.Network:
        """Untrained weights whose biases are the counts."""
        network, n = gru.Network(self.layout, HIDDEN), self.layout.n_words
        flat = np.zeros(self.layout.closed * PER_CLASS)
        flat[:n] = self.counts[:n] + SMOOTH
        table = flat.reshape(-1, PER_CLASS)
        sums = table.sum(axis=1)
        network.e[...] = np.where(table > 0, np.log(np.maximum(table, 1e-9) / np.maximum(sums, 1e-9)[:, None]), -1e9)
        classes = np.concatenate([sums, self.tokens + SMOOTH])
        network.d[...] = np.log(classes / classes.sum())
        return network


def _most_frequent(counted: DataFrame) -> list[tuple[str, int]]:
    """Words by falling count, as many whole levels of equal counts as fit into ``KNOWN``.

    Levels are far fewer than words, so no task sends more than it has of the result.
    """
    levels = counted.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).limit(KNOWN).collect()
    least, words = None, 0
    for level in levels:
        words += level["words"]
        if words > KNOWN:
            break
        least = level["n"]
    if least is None:
        return []
    rows = counted.where(F.col("n") >= least).collect()
    return sorted(((r["word"], r["n"]) for r in rows), key=lambda row: (-row[1], row[0]))


def vocabulary(counted: DataFrame) -> Vocabulary:
    sums = counted.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    known = _most_frequent(counted)
    closed = counted.sparkSession.createDataFrame([(w,) for w, _ in known[:CLOSED]], "word string")
    rest = counted.join(F.broadcast(closed), "word", "left_anti").groupBy(open_class(F.col("word")).alias("c"))
    of_class = {r["c"]: (r["n"], r["v"]) for r in rest.agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    return Vocabulary(known, sums["n"] or 0, sums["v"], of_class)


def read_texts(docs: DataFrame, shared) -> DataFrame:
    """Per document what the known words give, its rarer words, and ``ids``, the network ids of the
    whole text, from which both training and scoring go on."""
    names = ["row", "doc_id", "held_out", "round", "n_tokens", "n_known", "base", "model", "rare", "times", "ids"]
    types = ["long", "long", "boolean", "int", "long", "long", "double", "double", "array<string>", "array<long>", "array<int>"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        n = known.layout.n_words
        for batch in batches:
            made = []
            for name, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                said = words_of(text.as_py())
                ranks = np.array(known.ranks(said))
                ids = known.ids(said, ranks).astype(np.int32)
                found = ranks[ranks >= 0]
                rare = Counter(said[i] for i in np.flatnonzero(ranks < 0).tolist())
                open_ = ids >= n
                inside = known.log10[ranks[open_ & (ranks >= 0)]].sum() if len(found) else 0.0
                base = float(known.log10[found].sum() - len(said) * known.base_log10)
                model = float(inside - known.open_log[ids[open_] - n].sum() / np.log(10))
                drawn = zlib.crc32(f"{name}/{len(said)}".encode()) // 7 % ROUNDS
                made.append((drawn, len(said), len(found), base, model, list(rare), list(rare.values()), ids))
            columns = list(zip(*made)) or [()] * 8
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.int32()))
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds)]
            arrays[5] = arrays[5].cast(pa.list_(pa.string()))
            yield pa.record_batch([*(batch.column(c) for c in names[:3]), *arrays], names=names)

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        "text",
    )
    return map_batches(rows, run, ", ".join(f"{n} {t}" for n, t in zip(names, types)))


def _trained(texts: DataFrame, shards: int, shared, weights) -> DataFrame:
    """``weights`` and ``n``: what each shard makes of the weights, times its tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0

        def read() -> Iterator[np.ndarray]:
            nonlocal n
            for batch in batches:
                for row in batch.column("ids"):
                    ids = row.values.to_numpy()
                    n += len(ids)
                    yield ids

        network = shared.value.network().load(weights.value)
        gru.train(network, read(), TRAIN_LANES, WINDOW, RATE)
        if n:
            vector = network.vector().astype(np.float64) * n
            yield pa.record_batch([pa.array([vector.tobytes()], pa.binary()), pa.array([n], pa.int64())], names=["weights", "n"])

    return map_batches(texts.select("ids").coalesce(shards), run, "weights binary, n long")


def _added(rows: DataFrame, parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = None, 0
        for batch in batches:
            for weights, m in zip(batch.column("weights"), batch.column("n").to_pylist()):
                vector = np.frombuffer(weights.as_py())
                total, n = vector if total is None else total + vector, n + m
        if total is not None:
            yield pa.record_batch([pa.array([total.tobytes()], pa.binary()), pa.array([n], pa.int64())], names=["weights", "n"])

    return map_batches(rows.repartition(parts), run, "weights binary, n long")


def trained_weights(texts: DataFrame, shared) -> np.ndarray:
    """Weights after all rounds over ``texts``, stored rows of :func:`read_texts`."""
    spark = texts.sparkSession
    weights = shared.value.network().vector()
    for number in range(ROUNDS):
        mine = texts.where(~F.col("held_out") & (F.col("round") == number))
        shards = -(-(mine.agg(F.sum("n_tokens")).first()[0] or 0) // SHARD)
        if not shards:
            continue
        rows = durable(_trained(mine, shards, shared, spark.sparkContext.broadcast(weights)), "shard-weights")
        while shards > FAN_IN:
            shards = -(-shards // FAN_IN)
            rows = durable(_added(rows, shards), "added-weights")
        parts = rows.collect()  # at most FAN_IN sets of weights
        weights = (sum(np.frombuffer(r["weights"]) for r in parts) / sum(r["n"] for r in parts)).astype(np.float32)
    return weights


def _scored(texts: DataFrame, shared, weights) -> DataFrame:
    """The numbers of :func:`read_texts`, with what the network gives added to ``model``."""
    fields = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, model double"
    names = [field.split()[0] for field in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value.network().load(weights.value)
        for batch in batches:
            ids = [row.values.to_numpy() for row in batch.column("ids")]
            net = gru.score(network, ids, LANES, STEPS) / np.log(10)
            model = pa.array(batch.column("model").to_numpy() + net, pa.float64())
            yield pa.record_batch([*(batch.column(c) for c in names[:-1]), model], names=names)

    return map_batches(texts.select(*names, "ids"), run, fields)


def score(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score``, the log10 probability of the whole text."""
    context = docs.sparkSession.sparkContext
    training = docs.where(~held_out(F.col("doc_id")))
    counted = durable(counts(training), "word-counts")
    known = vocabulary(counted)
    shared = context.broadcast(known)
    texts = durable(read_texts(docs, shared), "texts")
    weights = context.broadcast(trained_weights(texts, shared))
    scored = _scored(texts, shared, weights)
    rare = texts.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select(
        "row", F.col("w.rare").alias("word"), F.col("w.times").alias("times")
    )
    n = F.coalesce("n", F.lit(0))
    # Whole billionths, so that sums do not depend on their order.
    part = F.round(F.log10(n + SMOOTH) * F.col("times") * 1e9).cast("long")
    added = (
        rare.join(counted, "word", "left")
        .groupBy("row")
        .agg(F.sum(part).alias("log"), F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("found"))
    )
    log = F.coalesce("log", F.lit(0)) / 1e9
    unknown = F.col("n_tokens") - F.col("n_known")
    return scored.join(added, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("found", F.lit(0))).alias("n_known"),
        F.lit(known.total).cast("long").alias("train_tokens"),
        (F.col("base") + log).alias("base_score"),
        (F.col("model") + log).alias("score"),
        F.greatest(unknown, F.lit(0)).alias("n_rare"),
    )
