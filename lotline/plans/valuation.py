"""Clean ads and location features to a tuned model and predictions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline import fixed_values as fv
from lotline.functions.columns import to_number, two_level_flag
from lotline.functions.geo import utm, utm_zone
from lotline.operators import features as ft
from lotline.operators import resample as rs
from lotline.operators.evaluate import final_prediction
from lotline.operators.skew import skew_join
from lotline.operators.tuning import SearchResult, grid_search
from lotline.staging import stage, stage_observed


def model_frame(clean: DataFrame, features: DataFrame, key: str = "property_id", target: str | None = "price") -> DataFrame:
    """Join by key, code the type of housing, keep the model's columns; rows without a target go."""
    joined = skew_join(clean, features, [key], "left")
    joined = joined.withColumn("apto_casa", two_level_flag("type_housing", fv.HOUSE, fv.FLAT))
    keep = [key, *[c for c in fv.PREDICTORS if c in joined.columns], "lon", "lat"]
    if target is None:
        return joined.select(*keep)
    priced = joined.withColumn(target, to_number(F.col(target).cast("string")))
    return priced.where(F.col(target).isNotNull()).select(*keep, target)


def project_to_utm(df: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Add x, y in the UTM zone of the mean longitude."""
    mean_lon = df.agg(F.avg(lon)).head()[0]
    x, y = utm(utm_zone(mean_lon)).forward(lon, lat)
    return df.withColumns({"x": x, "y": y})


def hexagon_roles(df: DataFrame, key: str, k: int = 5, size: float = fv.BLOCK_SIZE, seed: int = 0) -> DataFrame:
    """Fold roles by hexagonal blocks, with a buffer of half their size."""
    folds = rs.block_folds(rs.hexagon_cells(df, size), k, seed=seed)
    return rs.fold_roles(stage(folds, "folds"), k, key, buffer=size / 2)


def penalised_features(
    df: DataFrame, numeric: Sequence[str], categories: Sequence[str], interactions: Sequence[tuple[str, str]] = (),
    polynomials: Sequence[str] = (),
) -> DataFrame:
    """Add `features` for a penalised fit: products, then orthogonal terms of degree two in place of their columns, dummies, constant columns out, z-scores."""
    df = ft.interactions(df, interactions) if interactions else df
    for c in polynomials:
        df = ft.fit_polynomial(df, c).transform(df)
    columns = [*[c for c in numeric if c not in set(polynomials)], *[f"{a}_x_{b}" for a, b in interactions]]
    columns += [f"{c}_poly{d}" for c in polynomials for d in (1, 2)]
    return ft.preparation(columns, categories).fit(df).transform(df)


@dataclass
class Valuation:
    search: SearchResult
    predictors: Sequence[str]
    dropped_rows: int = 0

    def predict(self, df: DataFrame, train: DataFrame, target: str = "price") -> DataFrame:
        """Predictions inside the 1 and 99 per cent quantiles of the training target, rounded."""
        ready = VectorAssembler(inputCols=list(self.predictors), outputCol="features", handleInvalid="keep")
        scored = self.search.model.transform(ready.transform(df))
        return final_prediction(scored, "prediction", train, target)


def tune_with_spatial_folds(
    frame: DataFrame, learner: Callable[..., object], grid: Mapping[str, Sequence], key: str = "property_id",
    target: str = "price", k: int = 5, size: float = fv.BLOCK_SIZE,
) -> Valuation:
    """Assemble predictors, make buffered hexagon folds, search the grid, refit the best point.

    Rows that lack a predictor cannot be trained on; they are left out and counted in `dropped_rows`.
    """
    predictors = [c for c in frame.columns if c in fv.PREDICTORS]
    lacks = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in predictors])
    known, seen = stage_observed(project_to_utm(frame), "frame", {"lacking": F.count_if(lacks)})
    ready = VectorAssembler(inputCols=predictors, outputCol="features")
    data = stage(ready.transform(known.where(~lacks)).select(key, "features", F.col(target).alias("label"), "x", "y"), "frame")
    roles = stage(hexagon_roles(data, key, k, size), "roles")
    search = grid_search(data, learner, grid, k, roles=roles, key=key)
    return Valuation(search, predictors, seen["lacking"])
