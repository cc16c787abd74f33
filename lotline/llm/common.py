"""Small helpers that the corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Arrow batches stay small so that a run of very long texts cannot fill a Python worker
BATCH_ROWS = "256"
BATCH_BYTES = "16m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds, by rows and, where Spark knows the setting, by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def id_and_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the two columns an operator reads, so that other columns cannot clash; null text is empty."""
    return docs.select(
        docs[doc_id].cast("long").alias("doc_id"), F.coalesce(docs[text].cast("string"), F.lit("")).alias("text")
    )


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)).cast("int")


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts: one scan that moves one number per task."""
    return int(docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).head()[0] or 0)


def drawn(draw: Column, part: int, whole: int) -> Column:
    """True for about `part` of `whole` rows by their 64-bit hash, at any size; for all where `part` is not less."""
    if part >= whole:
        return F.lit(True)
    return draw.bitwiseAND(F.lit(2**63 - 1)) < F.lit(max(0, part) * 2**63 // whole)
