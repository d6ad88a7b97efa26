"""Registered queries of the corpus operators (one per operator) and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from editsurge.llm import (ann, bpe, corpus_oracles, decontaminate, imatch, infill, langid, minhash, oracles, resampling, secret_scan,
                           sharding, suffix_dedup, toxicity, wrappers)
from editsurge.llm.common import documents
from editsurge.sources.tables import read_table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql.strip()
        return fn
    return deco


@register("op9_bpe_codec")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(documents(spark, sf_dir, "doc_id", "text"))


@register("op4_secret_scan", oracles.secret_scan_sql())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(documents(spark, sf_dir, "doc_id", "text"))


@register("op6_sharding", oracles.sharding_sql())
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(documents(spark, sf_dir, "doc_id", "text"))


@register("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    return langid.digest(docs, langid.fit(docs))


@register("op7_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    return toxicity.digest(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels", "doc_id", "toxic")))


@register("op3_minhash_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.group(documents(spark, sf_dir, "doc_id", "text"))


@register("op10_ann_search")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


@register("op8_html_extraction")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(read_table(spark, sf_dir, "pages", "page_id", "url", "html"))


@register("op2_decontamination")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(documents(spark, sf_dir, "doc_id", "text"),
                                    read_table(spark, sf_dir, "benchmark", "item_id", "text"))


@register("op1_suffix_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(documents(spark, sf_dir, "doc_id", "text"))


@register("op11_importance_resampling", corpus_oracles.resampling_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.digest(documents(spark, sf_dir, "doc_id", "text"), read_table(spark, sf_dir, "benchmark", "text"))


@register("op12_imatch_fingerprint", corpus_oracles.imatch_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.digest(documents(spark, sf_dir, "doc_id", "text"))


@register("op13_fill_in_middle", corpus_oracles.infill_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digest(documents(spark, sf_dir, "doc_id", "text"))
