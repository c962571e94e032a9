"""Document quality from the document and from where it was found, by empirical Bayes.

A logistic regression over simple measures of the text gives each document its evidence, a
log likelihood ratio of good against bad. Sites are a host and a path below it. The rate of
good documents of a site is the mean of its documents, labelled ones by their label, others by
the probability their evidence gives under the global rate. Paths shrink toward their host and
hosts toward the global rate, as Beta priors whose strength is estimated from how much the
rates of sites differ beyond chance (method of moments). A document's own share, its label or the
probability that stood for it, is taken out of its host and its path before the path's posterior
becomes the prior of the document.

The regression is fitted on at most ``SAMPLE_ROWS`` labelled documents, those with the least
hash of doc_id; all sums over sites cover all documents.

Defined results: null texts count as empty; null hosts and paths are the site ''; labels that
are null or belong to no document are ignored, repeated labels of a document count once (the
least); without both classes among the labels the evidence is 0 and every document is kept;
repeated rows each count; extra columns pass through.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockrecon.llm.common import count_of, durable, leave_out, let, words

SAMPLE_ROWS = 20_000
#: Documents are kept from this probability of being good on.
KEEP_FROM = 0.5
#: Prior documents of a site, at least and at most.
WEAKEST, STRONGEST = 1.0, 1_000_000.0
RIDGE, STEPS = 1.0, 30


def features(text: Column) -> Column:
    """An array of doubles: shares of characters and words that tell prose from junk."""

    def of_words(t: Column, w: Column) -> Column:
        n = F.greatest(F.size(w), F.lit(1)).cast("double")
        chars = F.greatest(F.char_length(t), F.lit(1)).cast("double")
        hashed = F.transform(w, lambda x: F.xxhash64(x))
        share = [count_of(t, pattern) / chars for pattern in ("[A-Z]", "[#*$%&]", "[|]", "[!]", "[0-9]", "[.,]", "\n")]
        return F.array(
            *share,
            F.size(F.array_distinct(hashed)) / F.pow(n, F.lit(0.8)),
            F.least(chars / n, F.lit(40.0)) / 10,
            F.log1p(F.size(w).cast("double")),
        )

    return let(F.coalesce(text, F.lit("")), lambda t: let(words(t), lambda w: of_words(t, w)))


def fit(x: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept of a ridge logistic regression; the intercept leaves out the base rate."""
    if not len(x) or good.all() or not good.any():
        return np.zeros(x.shape[1] if x.ndim == 2 else 0), 0.0
    centre, scale = x.mean(0), x.std(0)
    scale[scale == 0] = 1.0
    z = np.column_stack([(x - centre) / scale, np.ones(len(x))])
    penalty = np.diag([RIDGE] * x.shape[1] + [0.0])
    w = np.zeros(z.shape[1])
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + penalty, z.T @ (good - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    weights = w[:-1] / scale
    rate = good.mean()
    return weights, float(w[-1] - weights @ centre - np.log(rate / (1 - rate)))


def sample(light: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Features and classes of at most ``rows`` labelled documents."""
    chosen = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = light.select("doc_id", "features").join(F.broadcast(chosen), "doc_id").orderBy("doc_id", "features")
    data = found.limit(2 * rows).select("features", "quality").collect()
    return np.array([r[0] for r in data], float), np.array([r[1] for r in data], float)


def evidence(columns: Column, weights: np.ndarray, intercept: float) -> Column:
    if not len(weights):
        return F.lit(0.0)
    terms = [F.get(columns, F.lit(i)) * float(w) for i, w in enumerate(weights)]
    return F.least(F.greatest(sum(terms, F.lit(intercept)), F.lit(-30.0)), F.lit(30.0))


def _logit(p: Column) -> Column:
    bounded = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(bounded / (1 - bounded))


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def strength(sites: DataFrame) -> float:
    """Prior documents of a level: how many documents a site needs to outweigh its parent.

    ``sites``: ``n``, ``good`` and ``parent``, the parent's rate. The spread of site means around the
    parent, less what chance alone explains, is the variance of the Beta prior.
    """
    mean, parent = F.col("good") / F.col("n"), F.col("parent")
    total = sites.where("n > 1").agg(
        F.sum(F.col("n") * (mean - parent) ** 2).alias("spread"),
        F.sum(parent * (1 - parent)).alias("chance"),
        F.sum("n").alias("n"),
        F.count("*").alias("sites"),
        F.sum(F.col("n") * parent * (1 - parent)).alias("binomial"),
    ).first()
    if not total["sites"] or not total["binomial"]:
        return STRONGEST
    between = (total["spread"] - total["chance"]) / total["n"]
    if between <= 0:
        return STRONGEST
    return float(np.clip(total["binomial"] / total["n"] / between - 1, WEAKEST, STRONGEST))


class Model(NamedTuple):
    """``sites``: one row per path with ``host``, ``path``, ``n``, ``good``, ``host_n``, ``host_good``."""

    sites: DataFrame
    weights: np.ndarray
    intercept: float
    rate: float
    share: float
    host_strength: float
    path_strength: float


def _good(units: str) -> Column:
    """Sums in whole millionths do not depend on the order of addition."""
    return F.sum(F.round(F.col(units) * 1_000_000).cast("long")) / 1_000_000


def _share_of(weights: np.ndarray, intercept: float, share: float) -> Column:
    """What a document adds to the good ones of its site: its label, else its probability, in whole millionths."""
    guess = _sigmoid(evidence(F.col("features"), weights, intercept) + _logit(F.lit(share)))
    return F.round(F.coalesce(F.col("quality").cast("double"), guess) * 1_000_000) / 1_000_000


def posteriors(light: DataFrame, weights: np.ndarray, intercept: float) -> Model:
    """Sums by path and host, the global rate and the strengths of the priors.

    ``light``: ``host``, ``path``, ``features`` and ``quality`` (null where there is no label).
    """
    sums = light.where("quality IS NOT NULL").agg(F.sum("quality").alias("g"), F.count("*").alias("n")).first()
    share = float(((sums["g"] or 0) + 1) / (sums["n"] + 2))
    judged = light.withColumn("good", _share_of(weights, intercept, share))
    paths = durable(judged.groupBy("host", "path").agg(F.count("*").alias("n"), _good("good").alias("good")), "paths")
    total = paths.agg(F.sum("n").alias("n"), _good("good").alias("good")).first()
    rate = float(((total["good"] or 0) + share) / ((total["n"] or 0) + 1))
    hosts = durable(paths.groupBy("host").agg(F.sum("n").alias("host_n"), _good("good").alias("host_good")), "hosts")
    of_hosts = strength(hosts.select(F.col("host_n").alias("n"), F.col("host_good").alias("good"), F.lit(rate).alias("parent")))
    sites = durable(paths.join(hosts, "host"), "sites")
    host_rate = (F.col("host_good") + of_hosts * rate) / (F.col("host_n") + of_hosts)
    return Model(sites, weights, intercept, rate, share, of_hosts, strength(sites.withColumn("parent", host_rate)))


def labelled(light: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``light`` with ``quality``, null where there is no label, and the labels, one per document."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    known = durable(known.groupBy("doc_id").agg(F.min("quality").alias("quality")), "labels")
    return durable(light.join(known, "doc_id", "left"), "labelled"), known


def model_of(light: DataFrame, known: DataFrame) -> Model:
    """Everything that is learned, from all documents as ``labelled`` gives them and the labels."""
    return posteriors(light, *fit(*sample(light.drop("quality"), known)))


def decide(light: DataFrame, model: Model, keep_from: float = KEEP_FROM) -> DataFrame:
    """``light`` with ``evidence``, ``site_rate``, ``quality`` (in place of the label) and ``kept``."""
    rows = light.join(model.sites.withColumnsRenamed({"good": "path_good", "n": "path_n"}), ["host", "path"], "left")
    llr = evidence(F.col("features"), model.weights, model.intercept)
    own = _share_of(model.weights, model.intercept, model.share)

    def others(n: str, good: str) -> tuple[Column, Column]:
        left = F.greatest(F.col(n) - 1, F.lit(0)).cast("double")
        return left, F.least(F.greatest(F.col(good) - own, F.lit(0.0)), left)

    n, good = others("host_n", "host_good")
    host_rate = (good + model.host_strength * model.rate) / (n + model.host_strength)
    n, good = others("path_n", "path_good")
    rate = F.round((good + model.path_strength * host_rate) / (n + model.path_strength), 9)
    quality = F.round(_sigmoid(llr + _logit(rate)), 9)
    fitted = F.lit(bool(len(model.weights) and np.any(model.weights)))
    return rows.select(
        *(c for c in light.columns if c != "quality"),
        llr.alias("evidence"),
        rate.alias("site_rate"),
        quality.alias("quality"),
        (~fitted | (quality >= keep_from)).alias("kept"),
    )


def _site(host: str, path: str) -> dict[str, Column]:
    return {n: F.coalesce(F.col(c), F.lit("")) for c, n in ((host, "host"), (path, "path"))}


def _light(docs: DataFrame, host: str, path: str) -> DataFrame:
    site = (column.alias(n) for n, column in _site(host, path).items())
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    return docs.select(doc_id, *site, F.xxhash64("text").alias("text_hash"), features(F.col("text")).alias("features"))


def _decided(docs: DataFrame, labels: DataFrame, host: str, path: str) -> DataFrame:
    rows, known = labelled(durable(_light(docs, host, path), "features"), labels)
    return decide(rows, model_of(rows, known))


def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """One row per document: ``doc_id``, ``host``, ``path``, ``evidence``, ``site_rate``, ``quality``, ``kept``."""
    return _decided(docs, labels, host, path).drop("text_hash", "features")


def keep(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """The rows of ``docs`` that pass, with the columns they came with.

    Decisions are made on the measures; the texts are read once for these and once to leave out
    what was rejected.
    """
    name = {"doc_id": F.col("doc_id").cast("long"), **_site(host, path), "text_hash": F.xxhash64("text")}
    rejected = _decided(docs, labels, host, path).where(~F.col("kept")).select(*name).distinct()
    return leave_out(docs, durable(rejected, "rejected"), name)
