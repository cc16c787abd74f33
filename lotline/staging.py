"""Cutting lineage between expensive steps.

A stage table is Parquet in the shared folder named by ``spark.checkpoint.dir``, so it outlives
lost executors and later steps read only the columns they need.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_WRITTEN: list[str] = []


def stage_root(spark: SparkSession) -> str:
    """The shared folder of the session; a private one only where driver and tasks are one process and none is set."""
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root
    if not re.fullmatch(r"local(\[[^\[\]]*\])?", spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="lotline-")
    spark.conf.set(CHECKPOINT_DIR, root)
    return root


def stage_path(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder, which `clear_stages` deletes with the stage tables."""
    path = f"{stage_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write the table once to the shared folder and go on from there."""
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_observed(df: DataFrame, name: str, metrics: Mapping[str, Column]) -> tuple[DataFrame, dict]:
    """Stage a table and get aggregates of it from the same job."""
    seen = Observation()
    staged = stage(df.observe(seen, *[e.alias(k) for k, e in metrics.items()]), name)
    return staged, seen.get


def clear_stages(spark: SparkSession) -> int:
    """Delete the stage tables that this driver has written, once no result that reads them is needed; their number."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    done = 0
    while _WRITTEN:
        path = hadoop.Path(_WRITTEN.pop())
        done += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return done
