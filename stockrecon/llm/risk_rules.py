"""Quality rules whose cutoffs are certified to reject few good documents.

Each rule rejects a document whose rate (per thousand) exceeds a cutoff. One half of the
labelled documents proposes, for each stratum and rule, the cutoff that best parts bad from
good. The other half, the holdout, certifies it: with ``n`` good holdout documents, a cutoff
that rejects ``k`` of them is certified if ``P(Binomial(n, alpha) <= k) <= delta``, that is, if
the exact (Clopper-Pearson) upper bound of its false rejection rate is at most ``alpha``. The
proposed cutoff is loosened until it is certified, which is a fixed sequence of tests from
loose to strict; ``alpha`` is split over the rules of a stratum that have a proposal and ``delta``
over all proposals (Bonferroni); the holdout has no part in what is proposed. So with probability
``1 - delta`` no stratum loses more than ``alpha`` of its good documents to the rules. A stratum with
too few labels gets no cutoff and loses nothing.

Defined results: null texts count as empty; a null stratum is the stratum ''; null labels, labels
without doc_id and labels of unknown documents are ignored. The bound needs independent labels, so a
document counts once, however often its label or its row is repeated: as good if all its labels
are, and with the least of its strata and rates. With no labels nothing is rejected but by the base
rule; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stockrecon.llm.common import NO_SPACE, count_of, durable, fresh, let, words
from stockrecon.operators.prefilter import hash_set, may_be_in

RULES = ("symbols", "repeated_lines", "repeated_words", "capitals")
SYMBOLS = "[#*$%&|<>]"
CAPITALS = "[A-Z]"
MIN_WORDS = 50
ALPHA, DELTA = 0.02, 0.05


def _repeat_words(grams: Column) -> Column:
    """Positions covered by three-word windows that occur twice or more, from window hashes."""

    def covered(ordered: Column) -> Column:
        same = F.filter(
            ordered,
            lambda x, i: F.coalesce(x["h"] == F.get(ordered, i - 1)["h"], F.lit(False))
            | F.coalesce(x["h"] == F.get(ordered, i + 1)["h"], F.lit(False)),
        )
        spread = F.transform(same, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))
        return F.size(F.array_distinct(F.flatten(spread)))

    numbered = F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(grams)) == F.size(grams), 0).otherwise(
        let(F.sort_array(numbered), covered)
    )


def _measures(text: Column) -> Column:
    def of_words(w: Column) -> Column:
        n = F.size(w)
        grams = F.when(n < 3, F.array().cast("array<bigint>")).otherwise(
            F.transform(
                F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))),
                lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
            )
        )
        return F.struct(
            n.cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            let(grams, _repeat_words).cast("long").alias("n_repeat_words"),
        )

    def of_lines(hashes: Column) -> Column:
        return F.struct(
            F.size(hashes).alias("n_lines"),
            (F.size(hashes) - F.size(F.array_distinct(hashes))).cast("long").alias("n_dup_lines"),
        )

    def of_text(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda line: line.rlike(NO_SPACE))
        return F.struct(
            let(words(t), of_words).alias("w"),
            let(F.transform(lines, lambda line: F.xxhash64(line)), of_lines).alias("l"),
            count_of(t, SYMBOLS).cast("long").alias("n_symbols"),
            count_of(t, CAPITALS).cast("long").alias("n_capitals"),
        )

    return let(F.coalesce(text, F.lit("")), of_text)


def _per_mille(part: Column, whole: Column) -> Column:
    return F.least(F.floor(1000 * part / F.greatest(whole, F.lit(1))).cast("int"), F.lit(1000))


def measured(text: Column, stratum: Column) -> Column:
    """A struct of the counts, the base rule, the stratum and the rates; the text is read once."""

    def of(m: Column) -> Column:
        w, line = m["w"], m["l"]
        rates = F.array(
            _per_mille(m["n_symbols"], w["word_chars"]),
            _per_mille(line["n_dup_lines"], line["n_lines"]),
            _per_mille(w["n_repeat_words"], w["n_words"]),
            _per_mille(m["n_capitals"], w["word_chars"]),
        )
        failed = (w["n_words"] < MIN_WORDS) | (100 * w["n_repeat_words"] > 50 * w["n_words"])
        return F.struct(
            w["n_words"].alias("n_words"),
            w["word_chars"].alias("word_chars"),
            m["n_symbols"].alias("n_symbols"),
            line["n_dup_lines"].alias("n_dup_lines"),
            w["n_repeat_words"].alias("n_repeat_words"),
            failed.alias("base_failed"),
            _stratum(stratum).alias("stratum"),
            rates.alias("rates"),
        )

    return let(_measures(text), of)


def _stratum(stratum: Column) -> Column:
    return F.coalesce(stratum, F.lit(""))


def allowed_rejections(n: Column, alpha: float | Column, delta: float | Column) -> Column:
    """The largest k with P(Binomial(n, alpha) <= k) <= delta; -1 if there is none.

    Terms of the distribution are summed from 0 on, each from the one before, as logarithms.
    The sum passes any delta below one half before n * alpha + 1.
    """
    alpha = alpha if isinstance(alpha, Column) else F.lit(alpha)
    odds = F.log(alpha / (1 - alpha))
    limit = delta if isinstance(delta, Column) else F.lit(delta)
    start = F.struct(
        (n * F.log(1 - alpha)).cast("double").alias("term"),
        F.lit(0.0).alias("sum"),
        F.lit(-1).cast("long").alias("k"),
    )

    def step(state: Column, i: Column) -> Column:
        total = state["sum"] + F.exp(state["term"])
        ratio = F.greatest((n - i).cast("double"), F.lit(1e-300)) / (i + 1)
        return F.struct(
            (state["term"] + F.log(ratio) + odds).cast("double").alias("term"),
            total.alias("sum"),
            F.when(total <= limit, i.cast("long")).otherwise(state["k"]).alias("k"),
        )

    last = F.least(n, F.ceil(n * alpha) + 1).cast("long")
    return F.aggregate(F.sequence(F.lit(0).cast("long"), last), start, step, lambda state: state["k"])


def cutoffs(measures: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per stratum: ``stratum`` and ``limits``, the certified cutoff of each rule or null.

    ``measures`` has ``doc_id``, ``stratum`` and ``rates``. Labels shrink to counts per rate
    (at most 1001 for each stratum and rule) before anything is ordered.
    """
    judged = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min(F.col("quality") == 1).alias("good"))
    )
    once = (
        measures.select("doc_id", "stratum", "rates")
        .join(judged, "doc_id")
        .groupBy("doc_id", "good")
        .agg(F.min(F.struct("stratum", "rates")).alias("m"))
        .select("m.*", "good", (F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0).alias("holdout"))
    )
    bins = (
        once.select("stratum", "good", "holdout", F.posexplode("rates").alias("rule", "rate"))
        .groupBy("stratum", "rule", "rate")
        .agg(
            F.count_if(F.col("good") & F.col("holdout")).alias("holdout_good"),
            F.count_if(F.col("good") & ~F.col("holdout")).alias("good"),
            F.count_if(~F.col("good") & ~F.col("holdout")).alias("bad"),
        )
    )
    bins = durable(bins, "rule-rates")
    group = Window.partitionBy("stratum", "rule")
    above = group.orderBy(F.col("rate").desc()).rowsBetween(Window.unboundedPreceding, -1)
    # A cutoff at this rate rejects what lies above it.
    counted = bins.select(
        "stratum",
        "rule",
        "rate",
        *(F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in ("holdout_good", "good", "bad")),
        *(F.sum(c).over(group).alias(f"{c}_all") for c in ("holdout_good", "good", "bad")),
    )
    gain = F.col("bad_above") / F.greatest("bad_all", F.lit(1)) - F.col("good_above") / F.greatest("good_all", F.lit(1))
    # What the other half proposes; the holdout only says how many good documents there are to test with.
    proposed = durable(
        counted.where(gain > 0)
        .groupBy("stratum", "rule")
        .agg(F.max_by("rate", F.struct(gain, "rate")).alias("proposed"), F.max("holdout_good_all").alias("n")),
        "rule-proposals",
    )
    tests = max(1, proposed.count())
    share = F.lit(float(alpha)) / F.count("*").over(Window.partitionBy("stratum"))
    allowed = proposed.withColumn("share", share).select(
        "stratum", "rule", "proposed", allowed_rejections(F.col("n"), F.col("share"), delta / tests).alias("allowed")
    )
    certified = F.col("holdout_good_above") <= F.col("allowed")
    chosen = (
        counted.join(allowed.where(F.col("allowed") >= 0), ["stratum", "rule"])
        .where(certified)
        .groupBy("stratum", "rule", "proposed")
        .agg(F.min("rate").alias("strictest"))
    )
    limit = F.greatest("proposed", "strictest")
    return chosen.groupBy("stratum").agg(
        F.array(*(F.max(F.when(F.col("rule") == i, limit)) for i in range(len(RULES)))).alias("limits")
    )


def _passes(m: Column, limits: Column) -> Column:
    """Whether measures meet the base rule and the cutoffs of their stratum, if it has any."""
    beyond = F.zip_with(m["rates"], limits, lambda rate, limit: F.coalesce(rate > limit, F.lit(False)))
    return ~m["base_failed"] & ~F.coalesce(F.exists(beyond, lambda x: x), F.lit(False))


def judge(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per document: ``doc_id``, the counts, ``base_failed`` and ``kept``."""
    m = durable(docs.select("doc_id", measured(F.col("text"), F.col("lang")).alias("m")).select("doc_id", "m.*"), "rule-measures")
    limits = durable(cutoffs(m, labels, alpha, delta), "rule-cutoffs")
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    kept = _passes(F.struct("base_failed", "rates"), F.col("limits"))
    return m.join(limits, "stratum", "left").select("doc_id", *counts, kept.alias("kept"))


def keep(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns they came with.

    Cutoffs need only the measures of labelled documents, which a bitmap of their ids finds.
    """
    id_ = F.xxhash64(F.col("doc_id").cast("long"))
    labelled = may_be_in(docs, hash_set(labels.where(F.col("quality").isNotNull()), id_), id_)
    rows = labelled.select("doc_id", measured(F.col("text"), F.col("lang")).alias("m"))
    light = durable(rows.select("doc_id", "m.stratum", "m.rates"), "rule-measures")
    found, key = fresh(docs, "limits"), fresh(docs, "stratum_of_limits")
    limits = durable(cutoffs(light, labels, alpha, delta), "rule-cutoffs")
    limits = limits.select(F.col("stratum").alias(key), F.col("limits").alias(found))
    joined = docs.join(limits, _stratum(F.col("lang")) == F.col(key), "left")
    passes = let(measured(F.col("text"), F.col("lang")), lambda m: _passes(m, F.col(found)))
    return joined.where(passes).select(*docs.columns)
