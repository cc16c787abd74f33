"""Corpus pipeline: one function per stage, from documents to documents, the last to token ids.

Each stage gets what the one before kept, as a table, and returns the columns of `documents`; the last returns
one row of token ids and digests per document. Models are learned from the labelled documents outside the
held-out fold that are still there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.llm import bpe, decontaminate, quality, simhash, toxicity
from lotline.llm.common import fold_of, table
from lotline.staging import stage


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as good stay."""
    weights = quality.learn(docs, table(spark, sf_dir, "labels"), fold_of(F.col("_label_id"), 5) != 0)
    return quality.keep_good(docs, weights)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not score as toxic stay."""
    lexicon = toxicity.learn_lexicon(docs, table(spark, sf_dir, "labels"), fold_of(F.col("_label_id"), 5) != 0)
    return toxicity.keep_clean(docs, lexicon)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.keep_one_per_group(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item stay."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of what they decode to."""
    return bpe.round_trip_digests(docs, with_ids=True)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("toxicity", toxicity_filter),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_bpe", byte_bpe),
]

# the stages learn models, hash shingles and merge bytes, which SQL cannot say
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
