"""Tables in and out. Schemas are given, never guessed."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LISTING_SCHEMA = (
    "property_id string, city string, price double, month int, year int, surface_total double, "
    "surface_covered double, rooms double, bedrooms double, bathrooms double, property_type string, "
    "lat double, lon double, title string, description string"
)


def read_listings(
    spark: SparkSession, path: str, schema: str | T.StructType = LISTING_SCHEMA, multi_line: bool = False
) -> DataFrame:
    """Ads from Parquet, or from delimited text with quoted fields.

    With `multi_line` quoted fields may hold line breaks; then a file cannot be split, so it is read by one task.
    A number that cannot be read becomes null; its row stays.
    """
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.schema(schema).parquet(path)
    return (
        spark.read.schema(schema)
        .option("header", True).option("multiLine", multi_line).option("escape", '"')
        .option("mode", "PERMISSIVE").csv(path)
    )


def read_layer(spark: SparkSession, path: str, srid: int, schema: str | T.StructType | None = None) -> DataFrame:
    """A point layer (id, attributes, x, y) or polygon layer (id, attributes, rings), with the number
    of its coordinate system in the column `srid`."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path).withColumn("srid", F.lit(srid))


def save_table(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Write a stage table and go on from the written rows."""
    df.write.mode(mode).parquet(path)
    return load_table(df.sparkSession, path, df.schema)


def load_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def prediction_name(model: str, params: Mapping[str, object]) -> str:
    """File name made of the model and its tuned parameters, without dots in the numbers."""
    parts = [f"{k}{str(v).replace('.', '')}" for k, v in params.items()]
    return re.sub(r"[^A-Za-z0-9_()-]", "_", "_".join([model, *parts]))


def write_predictions(
    df: DataFrame, folder: str, model: str, params: Mapping[str, object], key: str = "property_id",
    prediction: str | Column = "prediction", digits: int | None = 0,
) -> str:
    """Key and rounded prediction as CSV parts under a name made of the parameters; the path."""
    value = F.col(prediction) if isinstance(prediction, str) else prediction
    value = value if digits is None else F.bround(value, digits)
    path = f"{folder.rstrip('/')}/{prediction_name(model, params)}.csv"
    df.select(F.col(key), value.alias("price")).write.mode("overwrite").option("header", True).csv(path)
    return path


def write_report(df: DataFrame, path: str, format: str = "parquet") -> None:
    """A statistics table, in one part: it has a row per variable or grid point."""
    writer = df.repartition(1).write.mode("overwrite")
    writer.option("header", True).csv(path) if format == "csv" else writer.parquet(path)
