"""The operators of this package bound to the driver's tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lectern.llm import decontam, divergence, fim, mixing, neardup, pii, quality, secrets, tiff, tokencount, toxicity, urlfilter, vectorjoin

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(_table(spark, sf_dir, "pages"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, _table(spark, sf_dir, "labels")))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.score(docs, quality.learn(docs, _table(spark, sf_dir, "labels")))


def op6_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiff.payloads(_table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_table(spark, sf_dir, "documents"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(_table(spark, sf_dir, "documents"))


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(_table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorjoin.linked(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_url_filter": op1_url_filter,
    "op2_secrets": op2_secrets,
    "op3_toxicity": op3_toxicity,
    "op4_decontamination": op4_decontamination,
    "op5_quality": op5_quality,
    "op6_tiff": op6_tiff,
    "op7_pii": op7_pii,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_token_counts": op9_token_counts,
    "op10_mix": op10_mix,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_source_divergence": op12_source_divergence,
    "op13_jaccard_join": op13_jaccard_join,
}
ORACLES: dict[str, str] = {
    "op4_decontamination": decontam.SQL,
    "op10_mix": mixing.SQL,
    "op11_fill_in_middle": fim.SQL,
    "op12_source_divergence": divergence.SQL,
}
