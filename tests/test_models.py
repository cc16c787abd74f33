import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from lotline import fixed_values as fv
from lotline.operators import evaluate as ev
from lotline.operators import models as md
from lotline.operators import network as nw
from lotline.operators import stacking as sk
from lotline.operators.tuning import grid_search

RNG = np.random.default_rng(8)
N = 600


@pytest.fixture(scope="module")
def data(spark):
    a, b = RNG.normal(0, 1, N), RNG.normal(0, 1, N)
    pdf = pd.DataFrame({"id": range(N), "a": a, "b": b, "label": 5 + 3 * a - 2 * b + RNG.normal(0, 0.1, N)})
    df = spark.createDataFrame(pdf).withColumn("fold", (F.col("id") % 5).cast("int"))
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df).cache()


def test_least_squares_recovers_coefficients(spark, data):
    got = {r["term"]: r for r in md.coefficient_table(md.least_squares().fit(data), ["a", "b"]).collect()}
    assert got["a"]["estimate"] == pytest.approx(3, abs=0.02) and got["b"]["estimate"] == pytest.approx(-2, abs=0.02)
    assert got["(Intercept)"]["estimate"] == pytest.approx(5, abs=0.02) and got["a"]["p"] < 1e-10


def test_grids():
    lam = md.penalty_grid()
    assert len(lam) == 100 and lam[0] == pytest.approx(100) and lam[-1] == pytest.approx(1e-6)
    assert md.mixture_grid() == [0, 0.15, 0.3, 0.45, 0.6, 0.75, 0.9]


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (4.0, 3.0), (0.0, 1.0)], "o double, p double")
    r = ev.error_metrics(df, "o", "p").head()
    assert r["mae"] == 0.75 and r["rmse"] == pytest.approx(np.sqrt(0.75))
    assert r["mape"] == pytest.approx(100 * (1 + 0 + 0.25) / 3)
    assert r["r2_sse"] == pytest.approx(1 - 3 / np.var([1, 2, 4, 0]) / 4)
    own = ev.error_metrics(df, "o", "p", {"worst": lambda o, p: F.max(F.abs(o - p))}).head()
    assert own["worst"] == 1.0
    flags = ev.with_residuals(df, "o", "p").select("high_error").toPandas()
    assert flags.high_error.sum() == 0


def test_transformed_target_and_fallback(data):
    positive = data.withColumn("label", F.exp(F.col("a")))
    model = md.TransformedTarget(md.least_squares(), "log").fit(positive)
    assert ev.error_metrics(model.transform(positive), "label", "prediction", ["mae"]).head()["mae"] < 1e-6
    broken = md.WithFallback(md.least_squares(features="absent"))
    assert isinstance(broken.fit(data), md.ConstantModel) and broken.failure


def test_grid_search_orders_points(data):
    got = grid_search(data, md.elastic_net, {"penalty": [10.0, 0.0], "mixture": [0.5]}, 5)
    assert got.best == {"penalty": 0.0, "mixture": 0.5}
    table = got.table().toPandas().sort_values("mae")
    assert list(table.param_penalty) == [0.0, 10.0] and got.scores.count() == 10


def test_grid_search_with_roles(spark, data):
    roles = data.select("id", "fold", F.lit("test").alias("role")).unionByName(
        data.where("fold = 0").select("id", F.explode(F.array(*map(F.lit, [1, 2, 3, 4]))).alias("fold"), F.lit("train").alias("role"))
    ).unionByName(data.where("fold = 1").select("id", F.lit(0).alias("fold"), F.lit("train").alias("role")))
    got = grid_search(data, lambda c: md.least_squares(), [{"c": 1}], 5, roles=roles, key="id")
    assert got.scores.agg(F.sum("n")).head()[0] == N


def test_non_negative_weights_match_grid_search():
    for _ in range(20):
        z = RNG.normal(size=(50, 3))
        y = z @ RNG.normal(size=3) + RNG.normal(size=50)
        g, b = z.T @ z, z.T @ y
        w = sk.non_negative_weights(g, b)
        assert (w >= 0).all()
        value = w @ g @ w - 2 * w @ b
        for v in itertools.product(np.linspace(0, 3, 13), repeat=3):
            v = np.array(v)
            assert value <= v @ g @ v - 2 * v @ b + 1e-9


def test_stack_prefers_the_good_learner(data):
    model = sk.fit_stack(data, {"lm": md.least_squares(), "mean": md.MeanLearner()}, 5)
    assert sum(model.weights.values()) == pytest.approx(1) and min(model.weights.values()) >= 0
    assert model.weights["lm"] > 0.95
    assert ev.error_metrics(model.transform(data), "label", "prediction", ["mae"]).head()["mae"] < 0.3


def test_permutation_importance(data):
    model = md.least_squares().fit(data)

    class Plain:
        def transform(self, df):
            return model.transform(VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df.drop("features")))

    got = {r["variable"]: r["importance"] for r in ev.permutation_importance(
        Plain(), data, ["a", "b"], "label", ["id"], bucket_rows=100).collect()}
    assert got["a"] > got["b"] > 0.5
    moved = ev.shuffle_column(data, "a", ["id"], 6).toPandas()
    assert sorted(moved.a) == sorted(data.toPandas().a)


def test_network_gradient_matches_differences():
    sizes = nw._sizes(3, (4, 3))
    flat = nw._initial(sizes, 1)
    flat = flat + 0.1 * RNG.normal(size=len(flat))  # away from the kinks at zero
    x, y = RNG.normal(size=(20, 3)), RNG.normal(size=20)
    mask = nw._keep_mask(np.arange(20), 4, 2, 0.2) / 0.8
    for loss in ("absolute", "squared"):
        def total(f):
            e = nw._forward(x, nw._unpack(f, sizes), mask)[-1][:, 0] - y
            return np.abs(e).sum() if loss == "absolute" else (e**2).sum()

        g = nw._gradient(x, y, nw._unpack(flat, sizes), mask, loss)
        for i in range(0, len(flat), 5):
            step = np.zeros(len(flat))
            step[i] = 1e-6
            assert g[i] == pytest.approx((total(flat + step) - total(flat - step)) / 2e-6, abs=1e-4)


def test_network_learns_and_does_not_depend_on_partitions(data):
    learner = nw.NetworkRegressor(["a", "b"], epochs=15, rate=0.01, dropout=0.1, part_rows=200)
    one, many = learner.fit(data.repartition(1)), learner.fit(data.repartition(7))
    np.testing.assert_allclose(one.flat, many.flat, atol=1e-8)
    mae = ev.error_metrics(one.transform(data), "label", "prediction", ["mae"]).head()["mae"]
    base = ev.error_metrics(md.MeanLearner().fit(data).transform(data), "label", "prediction", ["mae"]).head()["mae"]
    assert mae < 0.6 * base


def test_one_part_is_mini_batch_training_on_one_machine(spark, data):
    """One epoch of one part, step by step."""
    learner = nw.NetworkRegressor(["a", "b"], units=(3,), dropout=0.0, epochs=1, batch=50, rate=0.01, held_out=0.0, keys=["id"])
    got = learner.fit(data.repartition(5))
    pdf = data.withColumn("mark", F.xxhash64(F.lit(0), "id")).toPandas()
    x = (pdf[["a", "b"]] - pdf[["a", "b"]].mean()) / pdf[["a", "b"]].std(ddof=0)
    y = (pdf.label - pdf.label.mean()) / pdf.label.std(ddof=0)
    order = np.argsort(pdf.mark.to_numpy())[np.random.default_rng([0, 0]).permutation(N)]
    sizes = nw._sizes(2, (3,))
    flat = nw._initial(sizes, 0)
    m, v = np.zeros_like(flat), np.zeros_like(flat)
    for t, at in enumerate(range(0, N, 50), 1):
        rows = order[at : at + 50]
        g = nw._gradient(x.to_numpy()[rows], y.to_numpy()[rows], nw._unpack(flat, sizes), None, "absolute") / 50
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        flat = flat - 0.01 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-7)
    np.testing.assert_allclose(got.flat, flat, atol=1e-10)


def test_full_grids_run_through_the_search(spark):
    from catalog import models_and_flows as flows
    from catalog.registry import QUERIES

    sf = "/root/testdata/sf0.001"
    forest = flows.random_forest_search(spark, sf, trees=1, depth=2, k=2)
    assert {(r["folds"], r["count"]) for r in forest.groupBy("folds").count().collect()} == {("random", 12), ("blocks", 9)}
    assert len(fv.FOREST_GRID["mtry"]) * len(fv.FOREST_GRID["min_node"]) == 12
    assert QUERIES["regression_tree_search"](spark, sf).count() == len(fv.TREE_CP_GRID)


def test_stages_can_be_cleared(spark, tmp_path):
    from lotline.staging import clear_stages, stage

    clear_stages(spark)
    stage(spark.range(3), "gone")
    assert clear_stages(spark) == 1 and clear_stages(spark) == 0


def test_parts_side_by_side_take_the_steps_of_each_part_alone(data, monkeypatch):
    """Stacked networks have the gradients of each; parts of unequal size and short last batches change nothing."""
    sizes = nw._sizes(2, (4, 3))
    flats = np.stack([nw._initial(sizes, s) for s in range(5)]) + 0.1 * RNG.normal(size=(5, 31))
    x, y, ids = RNG.normal(size=(5, 20, 2)), RNG.normal(size=(5, 20)), np.arange(100).reshape(5, 20)
    mask, count = nw._keep_mask(ids, 4, 2, 0.2) / 0.8, np.array([20, 17, 20, 1, 9])
    got = nw._gradient(x, y, nw._unpack(flats, sizes), mask, "absolute", np.arange(20) < count[:, None])
    for i, n in enumerate(count):
        own = nw._gradient(x[i, :n], y[i, :n], nw._unpack(flats[i], sizes), nw._keep_mask(ids[i, :n], 4, 2, 0.2) / 0.8, "absolute")
        np.testing.assert_allclose(got[i], own, atol=1e-12)
    for optimizer in ("adam", "rmsprop", "sgd"):
        learner = nw.NetworkRegressor(["a", "b"], epochs=3, rate=0.01, dropout=0.1, part_rows=50, batch=7, optimizer=optimizer)
        monkeypatch.setattr(nw, "PARTS_AT_ONCE", 32)
        many = learner.fit(data)
        monkeypatch.setattr(nw, "PARTS_AT_ONCE", 1)
        np.testing.assert_allclose(many.flat, learner.fit(data).flat, atol=1e-8)
