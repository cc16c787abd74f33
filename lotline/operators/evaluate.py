"""Scores, residuals and importance of fitted models."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotline.functions.columns import clip
from lotline.operators.quantiles import exact_median, exact_quantiles

Metric = Callable[[Column, Column], Column]

METRICS: dict[str, Metric] = {
    "mae": lambda o, p: F.avg(F.abs(o - p)),
    "rmse": lambda o, p: F.sqrt(F.avg((o - p) * (o - p))),
    "mape": lambda o, p: F.avg(F.abs(F.try_divide(o - p, o))) * 100,
    # null, and no error, for constant predictions
    "r2_cor": lambda o, p: F.try_divide(F.pow(F.covar_pop(o, p), 2), F.var_pop(o) * F.var_pop(p)),
    "r2_sse": lambda o, p: 1 - F.try_divide(F.sum((o - p) * (o - p)), F.var_pop(o) * F.count(o)),
    "mae_log": lambda o, p: F.avg(F.abs(F.log1p(o) - F.log1p(p))),
    "rmsle": lambda o, p: F.sqrt(F.avg(F.pow(F.log1p(o) - F.log1p(p), 2))),
}


def error_metrics(
    df: DataFrame, observed: str, predicted: str, metrics: Sequence[str] | Mapping[str, Metric] | None = None,
    groups: Sequence[str] = (),
) -> DataFrame:
    """Chosen metrics in one aggregate, for the whole table or by groups; own metrics are functions
    of (observed, predicted) that give an aggregate."""
    chosen = metrics if isinstance(metrics, Mapping) else {m: METRICS[m] for m in metrics or METRICS}
    pair = F.col(observed), F.col(predicted)
    return df.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), *[m(*pair).alias(k) for k, m in chosen.items()])


def median_error(df: DataFrame, observed: str, predicted: str) -> float | None:
    errors = df.select(F.abs(F.col(observed) - F.col(predicted)).alias("e"))
    return exact_median(errors, ["e"])["e"]


def with_residuals(df: DataFrame, observed: str, predicted: str) -> DataFrame:
    """Add residual, absolute error, and `high_error` where the error exceeds the median error."""
    middle = median_error(df, observed, predicted)
    r = F.col(observed) - F.col(predicted)
    high = (F.abs(r) > F.lit(middle).cast("double")).cast("int")
    return df.withColumns({"residual": r, "abs_error": F.abs(r), "high_error": high})


def final_prediction(
    df: DataFrame, predicted: str, train: DataFrame, target: str, low: float = 0.01, high: float = 0.99,
    digits: int = 0,
) -> DataFrame:
    """Predictions held between two quantiles of the training target and rounded half to even."""
    bounds = exact_quantiles(train, [target], [low, high])[target]
    return df.withColumn(predicted, F.bround(clip(predicted, *bounds), digits))


def impurity_importance(model: Model, names: Sequence[str], scale: bool = False) -> list[tuple[str, float]]:
    """Share of impurity reduction per feature, highest first; scaled to 100 for the best if wanted."""
    values = [float(v) for v in model.featureImportances.toArray()]
    factor = 100 / max(max(values), 1e-300) if scale else 1.0
    return sorted(((n, v * factor) for n, v in zip(names, values)), key=lambda r: (-r[1], r[0]))


def shuffle_column(df: DataFrame, column: str, keys: Sequence[str], buckets: int, seed: int = 0) -> DataFrame:
    """The column moved to other rows: one step round in a random order, within random buckets.

    Buckets come from the row keys, so they are all about rows/buckets in size whatever the data.
    """
    mark = F.xxhash64(F.lit(seed), *keys)
    inside = Window.partitionBy("_bucket").orderBy("_mark", *keys)
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    moved = F.coalesce(F.lead(column).over(inside), F.first(column).over(whole))
    return (
        df.withColumns({"_bucket": F.pmod(mark, F.lit(buckets)), "_mark": F.xxhash64(F.lit(seed + 1), *keys)})
        .withColumn(column, moved)
        .drop("_bucket", "_mark")
    )


def permutation_importance(
    model, df: DataFrame, columns: Sequence[str], label: str, keys: Sequence[str],
    prediction: str = "prediction", bucket_rows: int = 10_000, seed: int = 0,
) -> DataFrame:
    """Rise of the mean absolute error on held-out rows when one column is shuffled.

    `model` is anything with `transform` that starts from the plain columns.
    """
    def mae(scored):
        return F.avg(F.abs(F.col(label) - F.col(prediction)))

    n, base = model.transform(df).agg(F.count(F.lit(1)), mae(df)).head()
    buckets = max(1, n // bucket_rows)
    out = None
    for i, c in enumerate(columns):
        scored = model.transform(shuffle_column(df, c, keys, buckets, seed + 2 * i))
        row = scored.agg((mae(scored) - F.lit(base)).alias("importance")).select(F.lit(c).alias("variable"), "importance")
        out = row if out is None else out.unionByName(row)
    return out
