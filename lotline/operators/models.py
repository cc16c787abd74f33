"""Learners as Spark ML estimators, with the parameters of the trade translated.

Tree complexity is given relative to the variance of the target and becomes an absolute gain;
boosting rounds, learning rate, depth, node sizes and feature shares map one to one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Model
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.functions.columns import TARGET_TRANSFORMS
from lotline.operators.quantiles import exact_median


# rows that a task of a tree fit holds; each takes some 200 bytes in Spark's cache
FIT_ROWS = 500_000


def in_fit_tasks(df: DataFrame, columns: Sequence[str] = ("features", "label"), rows: int | None = None) -> DataFrame:
    """The columns of a fit, dealt to more tasks where one would hold more than `rows` rows; other tables keep their tasks.

    Trees keep their rows in memory, task by task, in a form that is much larger than the file a task reads.
    """
    rows = rows or FIT_ROWS
    n, most = df.groupBy(F.spark_partition_id()).count().agg(F.sum("count"), F.max("count")).head()
    narrow = df.select(*columns)
    return narrow.repartition(-(-n // rows)) if most is not None and most > rows else narrow


# what a row of a tree fit takes in Spark's cache, with its boosted predictions, and one more tree of a forest
FIT_ROW_BYTES, FIT_TREE_BYTES = 250, 4


def cache_room(spark: SparkSession) -> int:
    """Bytes that all executors have for cached rows."""
    status, room = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().valuesIterator(), 0
    while status.hasNext():
        room += status.next()._1()
    return room


def fits_at_once(df: DataFrame, most: int, share: float = 1.0, trees: int = 1) -> int:
    """How many tree fits on a share of these rows run side by side: at most `most`, and no more than keep their rows in memory.

    A fit reads its cached rows once per level; rows of fits beyond the memory go to disk and come back from there every time.
    """
    rows = df.count() * share * (FIT_ROW_BYTES + FIT_TREE_BYTES * trees)
    return max(1, min(most, int(cache_room(df.sparkSession) / rows))) if rows else most


def least_squares(label: str = "label", features: str = "features") -> LinearRegression:
    return LinearRegression(labelCol=label, featuresCol=features, solver="normal", regParam=0.0)


def coefficient_table(model, names: Sequence[str]) -> DataFrame:
    """Term, estimate, standard error, t and p of a least-squares fit, the intercept last."""
    s = model.summary
    values = [*[float(c) for c in model.coefficients], float(model.intercept)]
    rows = list(zip([*names, "(Intercept)"], values, s.coefficientStandardErrors, s.tValues, s.pValues))
    spark = SparkSession.active()
    return spark.createDataFrame(
        [tuple(r) for r in rows], "term string, estimate double, std_error double, t double, p double"
    )


def elastic_net(penalty: float, mixture: float, label="label", features="features") -> LinearRegression:
    return LinearRegression(
        labelCol=label, featuresCol=features, regParam=penalty, elasticNetParam=mixture, standardization=False
    )


def penalty_grid(points: int = 100, high: float = 2, low: float = -6) -> list[float]:
    """Even steps on the log scale from 10^high down to 10^low."""
    return [10 ** (high + (low - high) * i / (points - 1)) for i in range(points)]


def mixture_grid(step: float = 0.15) -> list[float]:
    return [round(i * step, 10) for i in range(int(1 / step) + 1)]


def target_variance(df: DataFrame, label: str) -> float:
    return df.agg(F.var_pop(label)).head()[0]


def regression_tree(
    variance: float, cp: float = 0.0, min_node: int = 20, depth: int = 10, label="label", features="features"
) -> DecisionTreeRegressor:
    """Tree whose splits must gain at least `cp` of the target variance."""
    return DecisionTreeRegressor(
        labelCol=label, featuresCol=features, maxDepth=depth, minInstancesPerNode=min_node,
        minInfoGain=cp * variance, seed=0,
    )


def random_forest(
    trees: int, mtry: int, min_node: int, depth: int = 12, label="label", features="features", seed: int = 0
) -> RandomForestRegressor:
    return RandomForestRegressor(
        labelCol=label, featuresCol=features, numTrees=trees, featureSubsetStrategy=str(mtry),
        minInstancesPerNode=min_node, maxDepth=depth, seed=seed,
    )


def absolute_loss_boosting(
    trees: int, depth: int, shrinkage: float, min_node: int, bag: float = 0.8,
    label="label", features="features", seed: int = 0,
) -> GBTRegressor:
    return GBTRegressor(
        labelCol=label, featuresCol=features, lossType="absolute", maxIter=trees, maxDepth=depth,
        stepSize=shrinkage, minInstancesPerNode=min_node, subsamplingRate=bag, seed=seed,
    )


def regularised_boosting(
    nrounds: int, max_depth: int, eta: float, gamma: float = 0.0, min_child_weight: int = 1,
    colsample: float = 1.0, subsample: float = 1.0, label="label", features="features", seed: int = 0,
) -> GBTRegressor:
    return GBTRegressor(
        labelCol=label, featuresCol=features, lossType="squared", maxIter=nrounds, maxDepth=max_depth,
        stepSize=eta, minInfoGain=gamma, minInstancesPerNode=min_child_weight,
        featureSubsetStrategy="all" if colsample >= 1 else str(colsample), subsamplingRate=subsample, seed=seed,
    )


@dataclass
class ConstantModel:
    """Predicts one number for every row."""

    value: float
    prediction: str = "prediction"

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.prediction, F.lit(float(self.value)))


@dataclass
class MeanLearner:
    """Baseline: mean (or exact median) of the target."""

    label: str = "label"
    statistic: str = "mean"

    def fit(self, df: DataFrame) -> ConstantModel:
        if self.statistic == "median":
            return ConstantModel(exact_median(df, [self.label])[self.label])
        return ConstantModel(df.agg(F.avg(self.label)).head()[0])


@dataclass
class WithFallback:
    """A learner that predicts the mean or median when its fit fails."""

    learner: Estimator
    label: str = "label"
    statistic: str = "mean"
    failure: list[str] = field(default_factory=list)

    def fit(self, df: DataFrame):
        try:
            return self.learner.fit(df)
        except Exception as problem:  # any failure of the learner, by design
            self.failure.append(str(problem))
            return MeanLearner(self.label, self.statistic).fit(df)


@dataclass
class TransformedModel:
    model: Model
    inverse: object
    prediction: str = "prediction"

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df).withColumn(self.prediction, self.inverse(F.col(self.prediction)))


@dataclass
class TransformedTarget:
    """Fit a learner on a transformed target; predictions come back on the first scale."""

    learner: Estimator
    transform_name: str = "log1p"
    label: str = "label"

    def fit(self, df: DataFrame) -> TransformedModel:
        forward, inverse = TARGET_TRANSFORMS[self.transform_name]
        return TransformedModel(self.learner.fit(df.withColumn(self.label, forward(F.col(self.label)))), inverse)
