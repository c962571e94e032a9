"""From raw documents to packed training sequences, one operator after the other."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stockrecon.llm import bin_slack, pfair, risk_rules, site_quality, superminhash
from stockrecon.llm.common import durable, table

#: Weights of sources are their sizes to this power, so that a hot source is held down.
FLATTEN = 0.5

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that text and site together make good."""
    return site_quality.keep(docs, table(spark, folder, "labels"))


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that pass the base rule and the certified cutoffs."""
    return risk_rules.keep(docs, table(spark, folder, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group that shares 80 % of its five-word shingles."""
    return superminhash.keep_one(docs)


def target_weights(docs: DataFrame) -> DataFrame:
    """What part of the mix a source should be: its size to the power of ``FLATTEN``, relative to the others."""
    return pfair.weights_of(docs, FLATTEN)


def mixture(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents in the order in which blocks of the sources take turns.

    The weights of the mix go along with the rows; packing follows them.
    """
    weights = {r["source"]: r["weight"] for r in target_weights(docs).collect()}
    return pfair.with_weights(pfair.in_order(docs, weights), weights)


def packing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of at most 1024 token ids and their place in training sequences.

    The mix is the one that the stage before laid down: its weights come with the documents, and
    documents that were not mixed are refused. The slot of a document follows from these weights,
    its source, id and text, so sequences keep to the mix whatever the order in which stored rows
    are read again.
    """
    return bin_slack.pack_in_order(docs, pfair.weights_with(docs))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_duplicates),
    ("mixing sources to target weights", mixture),
    ("packing", packing),
]

#: The classifier, cutoffs, signatures and token ids are beyond SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``; each is written before the next one reads it."""
    docs = table(spark, folder, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if number == 0 else durable(docs, f"stage-{number}"), folder)
    return docs
