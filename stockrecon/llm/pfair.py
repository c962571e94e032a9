"""Mixing sources to target weights by Pfair scheduling.

The documents of a source, in an order given by a hash, are cut into blocks of about equal
size. Time runs in slots, one block each. Block k (from 0) of a source with weight w may not run
before its release, floor(k / w), and must have run by its deadline, ceil((k + 1) / w). In each
slot the released block with the earliest deadline runs, which is feasible because the weights
add up to 1, and keeps every source within one block of its weight at every moment.

Weights are whole numbers out of 2**62, so a binary fraction of at least 2**-9 is exact and any
other one is within 2**-62; releases and deadlines are worked out from them in whole numbers over
all blocks there are, so a source stays within one block of its target however long the mix is.
The timetable is a fold over the blocks whose state is the next block of each source: only the
sizes of the sources go in and one row per block comes out, in time blocks x sources. When a source
has run out, its slots stay empty and the others keep their proportions; ``step`` numbers the
blocks without such gaps. A document longer than a block takes the turns of all blocks it covers.
The sources of a mixture are the named parts of a corpus, some thousands at most.

Defined results: a null source is the source ''; null and empty texts have size 0 and join the
block that is open; repeated rows keep their number; sources without a target weight share what
the targets leave, and come after all others if that is nothing; with no documents the result is
empty.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stockrecon.llm.common import durable, fresh, let

#: Slots of a cycle of ``schedule``, at least.
PERIOD = 1_000
#: Code points of a block.
BLOCK_CHARS = 100_000
#: Documents whose sizes are summed in one ordered run.
RUN_ROWS = 4_096
#: Blocks of the timetable that are laid in one fold, and in one row.
FOLD_BLOCKS, ROW_BLOCKS = 512, 131_072
#: Weights are whole numbers out of this.
WHOLE = 1 << 62
#: What targets leave below this is a rounding error of their sum.
NOTHING = 1e-9


def weights_of(docs: DataFrame, power: float = 0.5) -> DataFrame:
    """``source`` and ``weight``: the share of each source's size, flattened by ``power``."""
    size = F.greatest(F.char_length(F.coalesce("text", F.lit(""))), F.lit(1)).cast("long")
    sums = docs.groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(F.sum(size).alias("size"))
    return sums.select("source", F.pow(F.col("size").cast("double"), F.lit(power)).alias("weight"))


#: Key of the weights of a mix in the metadata of the column ``source``.
MIX = "mix"


def with_weights(docs: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """``docs`` with the weights of their mix, which stay with the column ``source`` when rows are stored."""
    known = dict(docs.schema["source"].metadata or {})
    return docs.withMetadata("source", known | {MIX: {"sources": list(weights), "weights": [float(w) for w in weights.values()]}})


def weights_with(docs: DataFrame) -> dict[str, float]:
    """The weights that :func:`with_weights` put to the documents; an error if there are none."""
    mix = (docs.schema["source"].metadata or {}).get(MIX)
    if mix is None:
        raise ValueError("these documents were not mixed: no weights in the metadata of their source")
    return dict(zip(mix["sources"], mix["weights"], strict=True))


def schedule(weights: DataFrame, period: int = PERIOD) -> DataFrame:
    """``source``, ``turn`` (from 0 within a period), ``slot`` (within a period), ``turns``, ``period``.

    A cycle that may be repeated, for callers that need one; a mix has its own :func:`timetable`.
    ``weights``: one row per source. Each source gets its share of the period in whole slots;
    what rounding leaves goes to the largest remainders, and sources without a slot have no row.
    """
    n = F.size("sources")
    total = F.aggregate("sources", F.lit(0.0), lambda s, x: s + x["weight"])
    # A period too short for the number of sources grows with it.
    slots = F.greatest(F.lit(period), n).cast("long")
    one = weights.where("weight > 0").agg(F.sort_array(F.collect_list(F.struct("source", "weight"))).alias("sources"))
    shares = one.select(
        slots.alias("period"),
        F.transform(
            "sources",
            lambda x: F.struct(
                x["source"].alias("source"),
                F.floor(slots * x["weight"] / total).cast("long").alias("base"),
                (slots * x["weight"] / total - F.floor(slots * x["weight"] / total)).alias("rest"),
            ),
        ).alias("shares"),
    )
    spare = F.col("period") - F.aggregate("shares", F.lit(0).cast("long"), lambda s, x: s + x["base"])
    ranked = F.transform(
        F.reverse(F.sort_array(F.transform("shares", lambda x: F.struct(x["rest"].alias("rest"), x["source"].alias("source"), x["base"].alias("base"))))),
        lambda x, i: F.struct(x["source"].alias("source"), (x["base"] + (i < spare).cast("long")).alias("turns")),
    )
    rated = shares.select("period", F.filter(ranked, lambda x: x["turns"] > 0).alias("rated"))

    def step(state: Column, t: Column) -> Column:
        due = F.array_min(
            F.filter(
                F.transform(
                    F.col("rated"),
                    lambda x, i: F.struct(
                        _deadline(F.get(state["done"], i), x["turns"]).alias("deadline"),
                        (F.floor(F.get(state["done"], i) * F.col("period") / x["turns"]) > t).alias("early"),
                        i.alias("i"),
                    ),
                ),
                lambda x: ~x["early"],
            )
        )
        chosen = due["i"]
        return F.struct(
            F.transform(state["done"], lambda d, i: d + (i == chosen).cast("long")).alias("done"),
            F.concat(state["order"], F.array(chosen)).alias("order"),
        )

    def _deadline(done: Column, turns: Column) -> Column:
        return F.ceil((done + 1) * F.col("period") / turns)

    start = F.struct(
        F.transform("rated", lambda x: F.lit(0).cast("long")).alias("done"), F.array().cast("array<int>").alias("order")
    )
    order = F.aggregate(F.sequence(F.lit(0).cast("long"), F.col("period") - 1), start, step, lambda s: s["order"])
    laid = rated.where(F.size("rated") > 0).select("period", "rated", F.posexplode(order).alias("slot", "i"))
    turn = Window.partitionBy("i").orderBy("slot")
    return laid.select(
        F.get("rated", F.col("i"))["source"].alias("source"),
        (F.row_number().over(turn) - 1).cast("long").alias("turn"),
        F.col("slot").cast("long").alias("slot"),
        F.get("rated", F.col("i"))["turns"].alias("turns"),
        "period",
    )


def _divided(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _next(i: Column, k: Column, blocks: Column, part: Column, total: Column) -> Column:
    """Block ``k`` of source ``i`` with its release and deadline."""
    number = k.cast("decimal(18,0)")
    release, due = _divided(number * total, part), _divided((number + 1) * total + part - 1, part)
    return F.struct(i.alias("i"), k.alias("k"), release.alias("release"), due.alias("due"), blocks.alias("blocks"), part.alias("part"))


def _shares(sources: DataFrame) -> DataFrame:
    """One row per group (1: sources that come after all others): ``names``, ``live``, ``total``, ``n``."""
    known = F.col("target").isNotNull()
    sums = sources.agg(
        F.coalesce(F.sum("target"), F.lit(0.0)).alias("named"),
        F.coalesce(F.sum(F.when(~known, F.col("weight"))), F.lit(0.0)).alias("rest"),
    )
    left = F.col("left")
    joined = sources.crossJoin(sums).withColumn("left", F.greatest(1 - F.col("named"), F.lit(0.0)))
    joined = joined.withColumn("group", (~known & (left <= NOTHING)).cast("int"))
    share = F.when(known, F.col("target") / F.greatest("named", F.lit(1.0))).otherwise(
        F.col("weight") / F.col("rest") * F.when(left > NOTHING, left).otherwise(1.0)
    )
    # Never so small that a release passes the largest number.
    part = F.greatest(F.floor(share * float(WHOLE)).cast("long"), F.col("blocks") + 1).cast("decimal(20,0)")
    grouped = joined.groupBy("group").agg(
        F.sort_array(F.collect_list(F.struct("source", "blocks", part.alias("part")))).alias("rows"),
        F.sum(part).cast("decimal(20,0)").alias("sum"),
        F.sum("blocks").alias("n"),
        (F.max(known) & F.max(~known)).alias("both"),
    )
    # Beside what targets leave, a target is a share of 1; else weights are relative to their sum.
    whole = F.lit(WHOLE).cast("decimal(20,0)")
    total = F.when(F.col("both"), F.greatest("sum", whole)).otherwise(F.col("sum")).alias("total")
    zero = F.lit(0).cast("long")
    return grouped.select("group", "rows", "n", total).select(
        "group",
        F.col("rows.source").alias("names"),
        F.transform("rows", lambda x, i: _next(i, zero, x["blocks"], x["part"], F.col("total"))).alias("live"),
        "total",
        "n",
    )


def _laid(state: Column, total: Column) -> Column:
    """The fold over ``FOLD_BLOCKS`` blocks: the state after them, and their order."""

    def step(s: Column, _: Column) -> Column:
        def run(slot: Column) -> Column:
            released = F.filter(s["live"], lambda x: x["release"] <= slot)
            first = F.array_min(F.transform(released, lambda x: F.struct(x["due"], x["i"], x["k"])))
            return let(first, lambda f: after(slot, f))

        def after(slot: Column, f: Column) -> Column:
            def moved(x: Column) -> Column:
                return F.when(x["i"] == f["i"], _next(x["i"], x["k"] + 1, x["blocks"], x["part"], total)).otherwise(x)

            live = F.filter(F.transform(s["live"], moved), lambda x: x["k"] < x["blocks"])
            laid = F.struct(f["i"].alias("i"), f["k"].alias("block"), slot.alias("slot"))
            return F.struct((slot + 1).alias("t"), live.alias("live"), F.concat(s["order"], F.array(laid)).alias("order"))

        slot = F.greatest(s["t"], F.array_min(F.transform(s["live"], lambda x: x["release"])))
        return F.when(F.size(s["live"]) == 0, s).otherwise(let(slot, run))

    none = F.array().cast("array<struct<i:int,block:bigint,slot:bigint>>")
    start = F.struct(state["t"].alias("t"), state["live"].alias("live"), none.alias("order"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(FOLD_BLOCKS)), start, step)


def timetable(sources: DataFrame) -> DataFrame:
    """``source``, ``block``, ``slot`` and ``step`` of every block.

    ``sources``: ``source``, ``target`` (null if it has none), ``weight`` among the sources without
    a target, which share what the targets leave, and ``blocks``, their number. If nothing is left,
    the blocks of these sources come after all others.
    """
    shares = durable(_shares(sources), "shares")
    parts, slots, steps = [], 0, 0
    for group, n in sorted((r["group"], r["n"]) for r in shares.select("group", "n").collect()):
        state = shares.where(F.col("group") == group).select("names", "total", F.lit(0).cast("long").alias("t"), "live")
        for first in range(0, n, ROW_BLOCKS):
            folds = -(-min(ROW_BLOCKS, n - first) // FOLD_BLOCKS)
            none = F.array().cast("array<array<struct<i:int,block:bigint,slot:bigint>>>")
            start = F.struct("t", "live", none.alias("orders"))

            def fold(s: Column, _: Column) -> Column:
                orders = lambda x: F.concat(s["orders"], F.array(x["order"]))
                return let(_laid(s, F.col("total")), lambda x: F.struct(x["t"], x["live"], orders(x).alias("orders")))

            end = F.aggregate(F.sequence(F.lit(1), F.lit(folds)), start, fold)
            row = durable(state.select("names", "total", end.alias("end")), "folds")
            each = row.select("names", F.posexplode(F.flatten("end.orders")).alias("nth", "x"))
            parts.append(
                each.select(
                    F.get("names", F.col("x.i")).alias("source"),
                    F.col("x.block").alias("block"),
                    (F.col("x.slot") + slots).alias("slot"),
                    (F.col("nth") + (steps + first)).cast("long").alias("step"),
                )
            )
            state = row.select("names", "total", "end.t", "end.live")
        steps += n
        slots += state.select("t").first()["t"]
    if not parts:
        return sources.sparkSession.createDataFrame([], "source string, block long, slot long, step long")
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def place_of() -> Column:
    return F.xxhash64("doc_id", "text")


def run_of(place: Column, runs: int) -> Column:
    """Places are spread evenly over the 64-bit numbers; the upper 31 bits pick the run."""
    return F.floor((F.shiftright(place, 33) + F.lit(1 << 30)) * runs / F.lit(1 << 31)).cast("long")


def _sizes(docs: DataFrame) -> DataFrame:
    return durable(
        docs.select(
            "doc_id",
            F.coalesce("source", F.lit("")).alias("source"),
            F.char_length(F.coalesce("text", F.lit(""))).cast("long").alias("size"),
            place_of().alias("place"),
        ),
        "sizes",
    )


def _runs(light: DataFrame) -> int:
    return max(1, -(-light.count() // RUN_ROWS))


def blocks(light: DataFrame, runs: int, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``place``, ``run`` and ``block`` (from 0) of every document.

    ``place`` is a hash that orders a source. The running size of a source is summed in two
    levels, within runs of about ``RUN_ROWS`` rows of neighbouring places and over the runs, so
    a source of any size is never ordered in one task. Only sizes and ids are shuffled.
    """
    placed = light.withColumn("run", run_of(F.col("place"), runs))
    inner = Window.partitionBy("source", "run").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("source", "run").agg(F.sum("size").alias("run_size"))
    starts = starts.select("source", "run", F.coalesce(F.sum("run_size").over(outer), F.lit(0)).alias("start"))
    summed = placed.withColumn("before", F.coalesce(F.sum("size").over(inner), F.lit(0))).join(starts, ["source", "run"])
    block = F.floor((F.col("start") + F.col("before")) / block_chars).cast("long")
    return summed.select("doc_id", "source", "size", "place", "run", block.alias("block"))


def mix(docs: DataFrame, weights: DataFrame | Mapping[str, float] | None = None, block_chars: int = BLOCK_CHARS, period: int | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``source``, ``size``, ``block``, ``slot`` and ``place``.

    Documents in the order of (``slot``, ``place``) are the mix. ``weights`` default to the
    flattened shares of :func:`weights_of`. ``period`` has no effect: the timetable has none.
    """
    light = _sizes(docs)
    laid = _timed(light, _runs(light), weights, block_chars)
    return laid.select("doc_id", "source", "size", "block", "slot", "place")


def _timed(light: DataFrame, runs: int, weights, block_chars: int) -> DataFrame:
    """The blocks of :func:`blocks` with their ``slot`` and ``step``."""
    sums = light.groupBy("source").agg(F.sum(F.greatest("size", F.lit(1))).alias("filled"), F.sum("size").alias("size"))
    found = sums.select(
        "source", F.sqrt(F.col("filled").cast("double")).alias("weight"), (F.floor(F.col("size") / block_chars) + 1).cast("long").alias("blocks")
    )
    if isinstance(weights, Mapping):
        weights = light.sparkSession.createDataFrame(list(weights.items()), "source string, weight double")
    sources = found.withColumn("target", F.lit(None).cast("double"))
    if weights is not None:
        sources = found.join(_targets(weights), "source", "left")
    plan = durable(timetable(sources), "timetable")
    return blocks(light, runs, block_chars).join(plan, ["source", "block"])


def _targets(weights: DataFrame) -> DataFrame:
    name = F.coalesce("source", F.lit("")).alias("source")
    return weights.where("weight > 0").groupBy(name).agg(F.max("weight").alias("target"))


def _with_targets(found: DataFrame, targets: DataFrame) -> DataFrame:
    """Targets for the sources they name; the others share what is left of 1 by their weights."""
    joined = durable(found.join(_targets(targets), "source", "left"), "target-weights")
    named, rest = joined.agg(
        F.coalesce(F.sum("target"), F.lit(0.0)), F.coalesce(F.sum(F.when(F.col("target").isNull(), F.col("weight"))), F.lit(0.0))
    ).first()
    left = max(0.0, 1.0 - named)
    share = F.col("weight") / (rest or 1.0) * max(left, 1e-9)
    return joined.select("source", F.coalesce("target", share).alias("weight"))


def starts(docs: DataFrame, weights: DataFrame | Mapping[str, float] | None = None) -> tuple[DataFrame, int]:
    """One row for each run of a source, and the number of runs a place falls into.

    Rows are ``source``, ``run`` and ``steps``, the places at which its slots begin, each with its
    ``slot`` and ``step``. They are few, about one for ``RUN_ROWS`` documents.
    """
    light = _sizes(docs)
    runs = _runs(light)
    begins = _timed(light, runs, weights, BLOCK_CHARS).groupBy("source", "run", "slot", "step").agg(F.min("place").alias("place"))
    rows = begins.groupBy("source", "run").agg(F.sort_array(F.collect_list(F.struct("place", "slot", "step"))).alias("steps"))
    return durable(rows, "slots"), runs


def in_order(docs: DataFrame, weights: DataFrame | Mapping[str, float] | None = None) -> DataFrame:
    """The rows of ``docs`` in the order of the mix: sorted across and within partitions.

    A document finds its slot from its source and place in the few rows of :func:`starts`, so
    texts are usually moved once, by the sort.
    """
    rows, runs = starts(docs, weights)
    source, run, steps = (fresh(docs, n) for n in ("mix_source", "mix_run", "mix_steps"))
    place, slot = fresh(docs, "mix_place"), fresh(docs, "mix_slot")
    rows = rows.select(F.col("source").alias(source), F.col("run").alias(run), F.col("steps").alias(steps))
    placed = docs.withColumn(place, place_of())
    same = (F.coalesce(F.col("source"), F.lit("")) == F.col(source)) & (run_of(F.col(place), runs) == F.col(run))
    last = F.element_at(F.filter(steps, lambda x: x["place"] <= F.col(place)), -1)
    joined = placed.join(rows, same).select(*docs.columns, last["slot"].alias(slot), place)
    return joined.orderBy(slot, place).select(*docs.columns)
