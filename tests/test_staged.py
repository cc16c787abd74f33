import threading

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from lotline import fixed_values as fv
from lotline.operators import evaluate as ev
from lotline.operators import forest as fo
from lotline.operators import models as md
from lotline.operators import pruning as pr
from lotline.operators import staged as sg
from lotline.operators import stacking as sk
from lotline.operators.tuning import grid_search

RNG = np.random.default_rng(31)
N = 400


@pytest.fixture(scope="module")
def data(spark):
    x = RNG.normal(0, 1, (N, 3))
    pdf = pd.DataFrame(x, columns=list("abc")).assign(label=20 + 3 * x[:, 0] + x[:, 1] ** 2 + RNG.normal(0, 0.3, N), fold=np.arange(N) % 3)
    df = spark.createDataFrame(pdf).withColumn("fold", F.col("fold").cast("int"))
    return VectorAssembler(inputCols=list("abc"), outputCol="features").transform(df).repartition(2).cache()


@pytest.mark.parametrize("learner", [
    lambda k: md.absolute_loss_boosting(k, 3, 0.3, 5, bag=0.8), lambda k: md.regularised_boosting(k, 2, 0.2, subsample=0.7, colsample=0.6)])
def test_a_prefix_is_the_model_of_that_many_rounds(data, learner):
    whole = learner(6).fit(data)
    got = sg.prefix_predictions(whole, data, [1, 3, 6, 9]).toPandas()
    for k in (1, 3, 6):
        own = learner(k).fit(data).transform(data).toPandas().prediction
        np.testing.assert_allclose(got[f"after_{k}"], own, rtol=1e-10)
        np.testing.assert_allclose(sg.prefix(whole, k).transform(data).toPandas().prediction, own, rtol=1e-10)
    np.testing.assert_allclose(got.after_9, got.after_6)
    assert list(got.columns) == [*data.columns, "after_1", "after_3", "after_6", "after_9"]


def test_search_equals_one_fit_per_point(data):
    grid, rounds = {"depth": [2, 3], "shrinkage": [0.3]}, [2, 4]
    got = sg.boosting_search(data, lambda depth, shrinkage: md.absolute_loss_boosting(1, depth, shrinkage, 5), grid, rounds, 3)
    slow = grid_search(data, lambda depth, shrinkage, trees: md.absolute_loss_boosting(trees, depth, shrinkage, 5), grid | {"trees": rounds}, 3)
    order = ["param_depth", "param_trees", "fold"]
    a, b = (r.scores.toPandas().sort_values(order).reset_index(drop=True) for r in (got, slow))
    pd.testing.assert_frame_equal(a[b.columns], b, check_dtype=False, rtol=1e-9)
    assert got.best == slow.best and got.model.model.getNumTrees == slow.best["trees"]


def test_transformed_target(data):
    learner = lambda depth: md.absolute_loss_boosting(1, depth, 0.3, 5)
    got = sg.boosting_search(data, learner, [{"depth": 2}], [1, 3], 3, metrics=("mae", "mae_log", "mape"), transform="log1p")
    for k in (1, 3):
        maes = []
        for f in range(3):
            fit = md.TransformedTarget(md.absolute_loss_boosting(k, 2, 0.3, 5)).fit(data.where(F.col("fold") != f))
            maes.append(ev.error_metrics(fit.transform(data.where(F.col("fold") == f)), "label", "prediction", ["mae"]).head()["mae"])
        assert got.table().where(f"param_trees = {k}").head()["mae"] == pytest.approx(np.mean(maes))
    assert got.model.transform(data).agg(F.avg("prediction")).head()[0] > 15


def test_full_shape_of_the_grid(data):
    grid = {c: v for c, v in fv.BOOSTING_GRID.items() if c != "trees"}
    points = sg.grid_points(grid)
    assert len(points) * len(fv.BOOSTING_GRID["trees"]) == 36
    got = sg.boosting_search(data, lambda depth, shrinkage, min_node: md.absolute_loss_boosting(1, min(depth, 3), shrinkage, min_node, fv.BOOSTING_BAG),
                             grid, [1, 2, 3], 2, parallelism=4)
    assert got.scores.count() == 36 * 2


def test_a_fit_holds_few_rows_per_task(data):
    """Rows are dealt to more tasks only where one has too many, and the trees stay the same."""
    assert md.in_fit_tasks(data).rdd.getNumPartitions() == 2
    dealt = md.in_fit_tasks(data, rows=90)
    sizes = dealt.groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert sizes.sum() == N and sizes.max() <= 90 and dealt.columns == ["features", "label"]
    learner = md.regularised_boosting(3, 2, 0.3)
    a, b = (learner.fit(df).transform(data).toPandas().prediction for df in (data, dealt))
    np.testing.assert_allclose(a, b, rtol=1e-9)


def searches(data, seen):
    """Each search with fits of a few trees; `seen` gets the threads that fit."""
    def boosting(depth, **other):
        seen.add(threading.get_ident())
        return md.regularised_boosting(1, depth, 0.3)

    class Mean(md.MeanLearner):
        def fit(self, df):
            seen.add(threading.get_ident())
            return super().fit(df)

    return {
        "boosting": lambda: sg.boosting_search(data, boosting, {"depth": [1, 2]}, [1, 2], 3, parallelism=4).table(),
        "grid": lambda: grid_search(data, boosting, {"depth": [1, 2]}, 3, parallelism=4).table(),
        "forest": lambda: fo.forest_search(data, [1, 2], [5], 2, 3, depth=2, parallelism=4).table(),
        "stack": lambda: sk.out_of_fold(data, {"mean": Mean(), "other": Mean()}, 3, parallelism=4),
    }


@pytest.mark.parametrize("name", ["boosting", "grid", "forest", "stack"])
def test_fits_run_side_by_side_only_as_far_as_their_rows_stay_in_memory(data, monkeypatch, name):
    seen, learner = set(), fo._forest
    monkeypatch.setattr(fo, "_forest", lambda *a, **b: (seen.add(threading.get_ident()), learner(*a, **b))[1])
    run = searches(data, seen)[name]
    wide = run().toPandas()
    assert len(seen - {threading.get_ident()}) > 1
    seen.clear()
    monkeypatch.setattr(md, "cache_room", lambda spark: 1.5 * N * md.FIT_ROW_BYTES * 2 / 3)
    narrow = run().toPandas()
    assert len(seen - {threading.get_ident()}) == 1
    wide, narrow = (t.drop(columns="features", errors="ignore").pipe(lambda t: t.sort_values(list(t.columns)).reset_index(drop=True)) for t in (wide, narrow))
    pd.testing.assert_frame_equal(wide, narrow)


def test_room_for_fits(data):
    """The memory of the session is counted, wide forests weigh more, and a single fit always runs."""
    assert md.cache_room(data.sparkSession) > 1e8
    assert md.fits_at_once(data, 4) == 4 and md.fits_at_once(data.limit(0), 3) == 3
    assert md.fits_at_once(data, 4, trees=10**7) == 1


def test_trees_of_a_search_grow_side_by_side_as_far_as_their_rows_stay_in_memory(data, monkeypatch):
    seen, grow = set(), pr.grow
    monkeypatch.setattr(pr, "grow", lambda *a: (seen.add(threading.get_ident()), grow(*a))[1])
    wide = pr.tree_search(data, [0.0, 0.01, 0.1], 3, depth=3)
    assert len(seen) > 1
    seen.clear()
    monkeypatch.setattr(md, "cache_room", lambda spark: 1.5 * N * md.FIT_ROW_BYTES)
    narrow = pr.tree_search(data, [0.0, 0.01, 0.1], 3, depth=3)
    assert len(seen) == 1 and wide.best == narrow.best
    a, b = (r.scores.toPandas().sort_values(["fold", "param_cp"]).reset_index(drop=True) for r in (wide, narrow))
    pd.testing.assert_frame_equal(a, b)
    assert len(a) == 9 and wide.model.tree.size(0.0) == narrow.model.tree.size(0.0) > 1
