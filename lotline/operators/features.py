"""Feature preparation: design matrices, coding, scaling, terms, selection."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    OneHotEncoder,
    RFormula,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VarianceThresholdSelector,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def design_matrix(df: DataFrame, formula: str, force_index: bool = False):
    """Fitted formula: `transform` adds `features` (reference level left out, no intercept) and `label`."""
    return RFormula(formula=formula, handleInvalid="keep" if force_index else "error").fit(df)


def levels_of(df: DataFrame, column: str) -> list:
    """Distinct values in order, null last. Each will be a column, so the column is meant to be a category."""
    values = [r[0] for r in df.select(column).distinct().collect()]
    return sorted(v for v in values if v is not None) + ([None] if None in values else [])


def one_hot_columns(df: DataFrame, column: str, levels: Sequence | None = None) -> DataFrame:
    """A 0/1 column per level, null being a level of its own; the source column goes.

    Give `levels` where they are known. For categories with very many values use `category_codes`, which needs one column.
    """
    levels = levels_of(df, column) if levels is None else levels
    flags = {
        f"{column}_{'NA' if v is None else v}": F.col(column).eqNullSafe(F.lit(v)).cast("int") for v in levels
    }
    return df.withColumns(flags).drop(column)


def category_codes(column: str, labels: Sequence[str], output: str) -> StringIndexerModel:
    """Index by a given list of labels; others go to one more index."""
    return StringIndexerModel.from_labels(list(labels), column, output, handleInvalid="keep")


def preparation(
    numeric: Sequence[str], categories: Sequence[str] = (), standardise: bool = True, output: str = "features"
) -> Pipeline:
    """Dummy coding with a place for unseen levels, constant columns dropped, z-scores."""
    stages, columns = [], list(numeric)
    for c in categories:
        stages += [
            StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid="keep"),
            OneHotEncoder(inputCol=f"{c}_index", outputCol=f"{c}_dummy"),
        ]
        columns.append(f"{c}_dummy")
    stages += [
        VectorAssembler(inputCols=columns, outputCol="_raw"),
        VarianceThresholdSelector(featuresCol="_raw", outputCol="_kept" if standardise else output,
                                  varianceThreshold=0.0),
    ]
    if standardise:
        stages.append(StandardScaler(inputCol="_kept", outputCol=output, withMean=True, withStd=True))
    return Pipeline(stages=stages)


def interactions(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Product columns a_x_b."""
    return df.withColumns({f"{a}_x_{b}": F.col(a) * F.col(b) for a, b in pairs})


@dataclass(frozen=True)
class ScaleModel:
    """z-scores with the mean and sample sd of the fitted table; constant columns give 0."""

    stats: Mapping[str, tuple[float, float]]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({
            c: (F.col(c) - F.lit(m)) / F.lit(sd) if sd else F.col(c) - F.lit(m)
            for c, (m, sd) in self.stats.items()
        })


def fit_scale(df: DataFrame, columns: Sequence[str]) -> ScaleModel:
    row = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(columns)],
    ).head()
    return ScaleModel({c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns)})


@dataclass(frozen=True)
class PolynomialModel:
    """Orthonormal polynomial terms of degree one and two of the fitted column."""

    column: str
    n: int
    mean: float
    s2: float
    s3: float
    s4: float

    def transform(self, df: DataFrame) -> DataFrame:
        d = F.col(self.column) - F.lit(self.mean)
        norm = math.sqrt(self.s4 - self.s3**2 / self.s2 - self.s2**2 / self.n)
        return df.withColumns({
            f"{self.column}_poly1": d / F.lit(math.sqrt(self.s2)),
            f"{self.column}_poly2": (d * d - F.lit(self.s3 / self.s2) * d - F.lit(self.s2 / self.n)) / F.lit(norm),
        })


def fit_polynomial(df: DataFrame, column: str) -> PolynomialModel:
    """One pass: count, mean and the central moments up to the fourth."""
    n, mean, var, skew, kurt = df.agg(
        F.count(column), F.avg(column), F.var_pop(column), F.skewness(column), F.kurtosis(column)
    ).head()
    return PolynomialModel(column, n, mean, n * var, n * skew * var**1.5, n * (kurt + 3) * var**2)


def top_features(importances: Sequence[float], names: Sequence[str], k: int) -> list[str]:
    """The k names with the highest importance, ties in column order."""
    ranked = sorted(zip(names, importances), key=lambda p: (-p[1], names.index(p[0])))
    return [name for name, _ in ranked[:k]]


def select_features(names: Sequence[str], chosen: Sequence[str], output: str = "selected") -> VectorSlicer:
    """Transformer that keeps the chosen slots of the feature vector."""
    return VectorSlicer(inputCol="features", outputCol=output, indices=[list(names).index(c) for c in chosen])
