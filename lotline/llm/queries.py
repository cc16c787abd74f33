"""Registered queries of the corpus operators, with production parameters on whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.llm import (
    bpe, decontaminate, langid, licenses, negatives, omh, pitman_yor, quality, secrets, shards, simhash, toxicity, variants,
)
from lotline.llm.common import table
from lotline.staging import stage_root

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.learn_and_score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.learn_and_score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{stage_root(spark).rstrip('/')}/shards-{uuid.uuid4().hex}"
    layout = shards.materialise(table(spark, sf_dir, "documents"), path)
    return shards.digests(shards.read_sequences(spark, path, layout))


@query
def op5_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score_documents(table(spark, sf_dir, "documents"))


@query
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"))


@query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL["op7_license_scan"] = licenses.scan_sql()


@query
def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return omh.compare_with_edits(table(spark, sf_dir, "documents"))


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", relabelled), F.col("vec_id") % 50 == 0)


SQL["op11_hard_negatives"] = negatives.CONTRACT_SQL


@query
def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.digests(secrets.find_secrets(docs, secrets.learn(docs)))


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(variants.vocabulary(table(spark, sf_dir, "documents")))


SQL["op13_spelling_variants"] = variants.contract_sql()
