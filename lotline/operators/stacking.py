"""Stacking: learners weighted by non-negative least squares on out-of-fold predictions."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from itertools import combinations
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline.operators.models import fits_at_once
from lotline.operators.tuning import fold_pairs
from lotline.staging import stage


def _score_all(models: Mapping[str, object], df: DataFrame) -> DataFrame:
    """One prediction column z_<name> per model, added one after the other: no join."""
    base = df.columns
    for name, model in models.items():
        df = model.transform(df).withColumnRenamed("prediction", f"z_{name}")
        base = [*base, f"z_{name}"]
        df = df.select(*base)
    return df


def out_of_fold(
    df: DataFrame, learners: Mapping[str, object], k: int, roles: DataFrame | None = None, key: str | None = None, parallelism: int = 8
) -> DataFrame:
    """Rows with each learner's prediction from the fit that did not see them; the fits run side by side as far as their rows stay in memory."""
    folds = list(fold_pairs(df, k, roles, key))
    trees = max((e.getNumTrees() for e in learners.values() if hasattr(e, "getNumTrees")), default=1)
    with ThreadPool(fits_at_once(df, parallelism, 1 - 1 / k, trees)) as pool:
        fitted = pool.map(lambda job: job[1].fit(folds[job[0]][0]), [(f, e) for f in range(k) for e in learners.values()], chunksize=1)
    out = None
    for f, (_, test) in enumerate(folds):
        scored = _score_all(dict(zip(learners, fitted[f * len(learners) :])), test)
        out = scored if out is None else out.unionByName(scored)
    return out


def gram(df: DataFrame, names: list[str], label: str) -> DataFrame:
    """Sums of products of the predictions with each other and with the target, one pass."""
    z = {n: F.col(f"z_{n}") for n in names} | {"y": F.col(label)}
    pairs = [(a, b) for i, a in enumerate(names) for b in [*names[i:], "y"]]
    row = df.agg(*[F.sum(z[a] * z[b]).alias(f"s{i}") for i, (a, b) in enumerate(pairs)])
    lines = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"s{i}").alias("s"))
        for i, (a, b) in enumerate(pairs)
    ]
    return row.select(F.inline(F.array(*lines)))


def non_negative_weights(g: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimiser of w'Gw - 2w'b over w >= 0 for a handful of learners: the best subset solution."""
    k, best, best_value = len(b), np.zeros(len(b)), 0.0
    for size in range(1, k + 1):
        for subset in combinations(range(k), size):
            part = list(subset)
            w = np.linalg.lstsq(g[np.ix_(part, part)], b[part], rcond=None)[0]
            value = w @ g[np.ix_(part, part)] @ w - 2 * w @ b[part]
            if (w >= 0).all() and value < best_value:
                best, best_value = np.zeros(k), value
                best[part] = w
    return best


@dataclass
class StackModel:
    models: Mapping[str, object]
    weights: Mapping[str, float]

    def combined(self) -> Column:
        return sum((F.col(f"z_{n}") * F.lit(w) for n, w in self.weights.items()), F.lit(0.0))

    def transform(self, df: DataFrame) -> DataFrame:
        return _score_all(self.models, df).withColumn("prediction", self.combined())


def fit_stack(
    df: DataFrame, learners: Mapping[str, object], k: int, label: str = "label",
    roles: DataFrame | None = None, key: str | None = None,
) -> StackModel:
    """Weights from held-out predictions, scaled to sum 1; then every learner fitted on all rows."""
    names = list(learners)
    held_out = stage(out_of_fold(df, learners, k, roles, key).select(label, *[f"z_{n}" for n in names]), "oof")
    sums = {(r["a"], r["b"]): r["s"] for r in gram(held_out, names, label).collect()}
    g = np.array([[sums.get((a, b), sums.get((b, a))) for b in names] for a in names])
    w = non_negative_weights(g, np.array([sums[(a, "y")] for a in names]))
    w = w / w.sum() if w.sum() > 0 else np.full(len(names), 1 / len(names))
    return StackModel({n: e.fit(df) for n, e in learners.items()}, dict(zip(names, map(float, w))))
