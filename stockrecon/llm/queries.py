"""The operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockrecon.llm import (
    bin_slack,
    chat_format,
    lexical,
    licenses,
    lm_score,
    nra,
    page_diff,
    pfair,
    phrases,
    risk_rules,
    site_quality,
    superminhash,
    url_filter,
)
from stockrecon.llm.common import durable, table


#: Every 50th vector, by id, is a query.
EVERY = 50


def op1_nra(spark: SparkSession, folder: str) -> DataFrame:
    vectors = durable(nra.quantised(table(spark, folder, "embeddings")), "vectors")
    return nra.search(vectors.where(F.col("id") % EVERY == 0), vectors)


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages"))


def op3_gru(spark: SparkSession, folder: str) -> DataFrame:
    return lm_score.score(table(spark, folder, "documents"))


def op4_risk_rules(spark: SparkSession, folder: str) -> DataFrame:
    return risk_rules.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_superminhash(spark: SparkSession, folder: str) -> DataFrame:
    return superminhash.components_of(table(spark, folder, "documents"), size=2)


def op6_bin_slack(spark: SparkSession, folder: str) -> DataFrame:
    return bin_slack.pack(table(spark, folder, "documents"))


def op7_site_quality(spark: SparkSession, folder: str) -> DataFrame:
    return site_quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_page_diff(spark: SparkSession, folder: str) -> DataFrame:
    return page_diff.extract(table(spark, folder, "pages"))


def op9_pfair(spark: SparkSession, folder: str) -> DataFrame:
    return pfair.mix(table(spark, folder, "documents"))


def op10_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"SELECT -1L conv_id, turn, role, '{said}' text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    records = chat_format.records_of_rows(rows.unionByName(extra))
    formatted = chat_format.format_turns(chat_format.canonical(records).select("conv_id", "turns"))
    return chat_format.digests(formatted)


def op11_misra_gries(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


def op12_bag_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(table(spark, folder, "benchmark"), table(spark, folder, "documents"))


def op13_suffix_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.digests(licenses.scan(table(spark, folder, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_nra": op1_nra,
    "op2_url_filter": op2_url_filter,
    "op3_gru": op3_gru,
    "op4_risk_rules": op4_risk_rules,
    "op5_superminhash": op5_superminhash,
    "op6_bin_slack": op6_bin_slack,
    "op7_site_quality": op7_site_quality,
    "op8_page_diff": op8_page_diff,
    "op9_pfair": op9_pfair,
    "op10_chat_format": op10_chat_format,
    "op11_misra_gries": op11_misra_gries,
    "op12_bag_search": op12_bag_search,
    "op13_suffix_licenses": op13_suffix_licenses,
}
