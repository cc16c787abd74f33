"""Boosting searched over its number of rounds with one fit per point.

The first k trees of a boosted model are the model of k rounds, so the rounds of a grid need no fits of their own. The trees between two
round numbers make a model each; their predictions add up to those of every prefix, in one pass and without Python.
Absolute loss on few features is fitted on their cells (`cells`), where a round does not read the table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import SparkContext
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline.functions.columns import TARGET_TRANSFORMS
from lotline.operators import cells as ce
from lotline.operators.evaluate import METRICS
from lotline.operators.models import TransformedModel, fits_at_once
from lotline.operators.tuning import DEFAULT_METRICS, SearchResult, fold_pairs, grid_points
from lotline.staging import stage, stage_root


def _between(model: GBTRegressionModel, start: int, end: int) -> GBTRegressionModel:
    """The model of the trees start..end-1."""
    gateway = SparkContext._active_spark_context._gateway
    trees, all_weights = model._java_obj.trees(), model._java_obj.treeWeights()
    kind = gateway.jvm.org.apache.spark.ml.regression
    own, weights = gateway.new_array(kind.DecisionTreeRegressionModel, end - start), gateway.new_array(gateway.jvm.double, end - start)
    for i in range(start, end):
        own[i - start], weights[i - start] = trees[i], all_weights[i]
    part = GBTRegressionModel(kind.GBTRegressionModel(f"{model.uid}_{start}_{end}", own, weights, model.numFeatures))
    return part.setFeaturesCol(model.getFeaturesCol())


def prefix(model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The model after so many rounds."""
    return _between(model, 0, min(rounds, model.getNumTrees))


def prefix_predictions(model: GBTRegressionModel, df: DataFrame, rounds: Sequence[int], name: str = "after_") -> DataFrame:
    """Add after_<k>, the prediction of the first k trees, for every k of `rounds`; each tree is evaluated once per row.

    A k beyond the trees there are gives the prediction of all of them.
    """
    base, total, start = df.columns, F.lit(0.0), 0
    added = []
    for k in sorted(set(rounds)):
        end = min(k, model.getNumTrees)
        if end > start:
            df = _between(model, start, end).setPredictionCol(f"_part_{end}").transform(df)
            total, start = total + F.col(f"_part_{end}"), end
        added.append(total.alias(f"{name}{k}"))
    return df.select(*base, *added)


def _cells_of(known: DataFrame, learners: Sequence[GBTRegressor], trains: Sequence[DataFrame]) -> list[ce.Cells] | None:
    """The cells of each table, or None where a learner or a table is none for them."""
    if not learners or not all(ce.fits_on_cells(one, known) for one in learners):
        return None
    if len({(one.getFeaturesCol(), one.getMaxBins(), one.getSeed()) for one in learners}) > 1:
        return None
    found = []
    for train in [*trains, known]:
        cells, rows = ce.find_cells(train, learners[0].getFeaturesCol(), learners[0].getMaxBins(), learners[0].getSeed())
        if cells.size > min(rows, ce.CELLS):
            return None
        found.append(cells)
    return found


def _on_cells(folds: Sequence[tuple], found: Sequence[ce.Cells], learners: Sequence[GBTRegressor], rounds: Sequence[int], label: str,
              forward: Callable, measured: Callable) -> tuple[list, Callable]:
    """(point, fold, measures) of every fit on cells, and a function that fits a point on all rows; `found` ends with the cells of these."""
    features = learners[0].getFeaturesCol()

    def targets(rows: DataFrame, cells: ce.Cells) -> DataFrame:
        return ce.target_counts(rows.withColumn("_target", forward(F.col(label))), cells, features, "_target")

    def prepare(job):
        (train, test), cells = job
        return targets(train, cells), stage(cells.of(test, features, [label]), "held_out")

    def score(job):
        i, f = job
        values = ce.boost(staged[f][0], found[f], learners[i], rounds)
        by_cell = pd.DataFrame({"_cell": np.arange(found[f].size, dtype=np.int32)} | {f"after_{r}": v for r, v in zip(rounds, values)})
        return i, f, measured(staged[f][1].join(F.broadcast(staged[f][1].sparkSession.createDataFrame(by_cell)), "_cell"))

    def fit(i: int, rows: DataFrame, trees: int) -> ce.CellModel:
        return ce.CellModel(found[-1], ce.boost(targets(rows, found[-1]), found[-1], learners[i], [trees])[0], trees, features)

    with ThreadPool(folds[0][0].sparkSession.sparkContext.defaultParallelism) as pool:
        staged = pool.map(prepare, list(zip(folds, found)), chunksize=1)
        return pool.map(score, [(i, f) for i in range(len(learners)) for f in range(len(folds))], chunksize=1), fit


def boosting_search(
    df: DataFrame, learner: Callable[..., GBTRegressor], grid: Mapping[str, Sequence] | Sequence[dict], rounds: Sequence[int], k: int,
    label: str = "label", metric: str = "mae", metrics: Sequence[str] = DEFAULT_METRICS, transform: str | None = None,
    roles: DataFrame | None = None, key: str | None = None, parallelism: int = 2,
) -> SearchResult:
    """Every grid point with every number of rounds on every fold, from one fit per point and fold.

    `learner(**point)` is an estimator whose rounds are set here to the largest of `rounds`; `transform` names a transform of the target,
    undone before scoring. Lower is better, but for the R2 metrics; ties go to the earlier point, then to fewer rounds. The
    result's `param_trees` is the rounds axis and its model the best point after its rounds, fitted on all rows. `df` is best staged before. Fits run side by
    side as far as their rows stay in memory.

    Where every learner is fitted by absolute loss without weights and categories, and no table has fewer rows than its features have cells,
    fits are made on cells: one task each, as many at once as the session has cores. Their bags are other draws of the same share.
    """
    points = grid_points(grid) if isinstance(grid, Mapping) else list(grid)
    rounds = sorted(set(rounds))
    forward, inverse = TARGET_TRANSFORMS[transform] if transform else (lambda c: c, lambda c: c)
    known = df.where(F.col(label).isNotNull())
    folds = list(fold_pairs(known, k, roles, key))

    def measured(scored: DataFrame):
        measures = [METRICS[m](F.col(label), inverse(F.col(f"after_{r}"))).alias(f"{m}_{r}") for r in rounds for m in metrics]
        return scored.agg(F.count(F.lit(1)).alias("n"), *measures).head()

    kinds = [learner(**point) for point in points]
    found = _cells_of(known, kinds, [train for train, _ in folds])
    if found:
        done, fit = _on_cells(folds, found, kinds, rounds, label, forward, measured)
    else:
        context = df.sparkSession.sparkContext
        if context.getCheckpointDir() is None:  # the lineage of a long fit is cut there
            context.setCheckpointDir(stage_root(df.sparkSession))

        def fit(i: int, rows: DataFrame, trees: int) -> GBTRegressionModel:
            return learner(**points[i]).setMaxIter(trees).setLabelCol("_target").fit(rows.withColumn("_target", forward(F.col(label))))

        def score(job):
            i, (f, (train, test)) = job
            return i, f, measured(prefix_predictions(fit(i, train, rounds[-1]), test, rounds))

        with ThreadPool(fits_at_once(df, parallelism, 1 - 1 / k)) as pool:
            done = pool.map(score, [(i, f) for i in range(len(points)) for f in enumerate(folds)], chunksize=1)
    rows, sums = [], {}
    for i, f, row in done:
        for r in rounds:
            rows.append((*map(float, points[i].values()), r, f, row["n"], *[row[f"{m}_{r}"] for m in metrics]))
            if row[f"{metric}_{r}"] is not None:
                sums.setdefault((i, r), []).append(row[f"{metric}_{r}"])
    sign = -1 if metric.startswith("r2") else 1
    i, trees = min(sums, key=lambda at: (sign * sum(sums[at]) / len(sums[at]), at))
    schema = ", ".join([f"param_{p} double" for p in points[0]] + ["param_trees int", "fold int", "n long"] + [f"{m} double" for m in metrics])
    model = fit(i, known, trees)
    return SearchResult(df.sparkSession.createDataFrame(rows, schema), points[i] | {"trees": trees}, TransformedModel(model, inverse))
