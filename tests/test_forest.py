import time

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from lotline import fixed_values as fv
from lotline.operators import evaluate as ev
from lotline.operators import forest as fo

RNG = np.random.default_rng(41)
N = 800
COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    x = RNG.normal(0, 1, (N, 3))
    y = 30 + 4 * x[:, 0] + 2 * (x[:, 1] > 0) + RNG.normal(0, 0.5, N)
    df = spark.createDataFrame(pd.DataFrame(x, columns=COLUMNS).assign(id=np.arange(N), label=y, fold=np.arange(N) % 3)).withColumn("fold", F.col("fold").cast("int"))
    return VectorAssembler(inputCols=COLUMNS, outputCol="features").transform(df).repartition(3).cache()


@pytest.fixture(scope="module")
def model(data):
    return fo._forest(4, 2, 6, 32, "label", "features", 3).fit(data)


def read_tree(tree):
    """(count, prediction, left, right) from the model itself."""
    def visit(node):
        inner = node.getClass().getSimpleName() == "InternalNode"
        return node.impurityStats().count(), node.prediction(), visit(node.leftChild()) if inner else None, visit(node.rightChild()) if inner else None

    return visit(tree._java_obj.rootNode())


def leaves(node, size, stopped=None):
    """Value of each leaf, left to right, once nodes under a size are leaves."""
    count, mean, left, right = node
    here = stopped if stopped is not None else (mean if count < size else None)
    if left is None:
        return [mean if here is None else here]
    return leaves(left, size, here) + leaves(right, size, here)


@pytest.mark.parametrize("size", [0, 5, 20, 90, 10_000])
def test_cutting_back(model, size):
    want = [v for t in model.trees for v in leaves(read_tree(t), size)]
    np.testing.assert_allclose(fo.forest_nodes(model).leaf_values(size), want)


def test_uncut_forest_predicts_as_the_model(data, model):
    a = fo.CutForest(model, 0).transform(data).orderBy("id").toPandas().prediction
    b = model.transform(data).orderBy("id").toPandas().prediction
    np.testing.assert_allclose(a, b)


def test_scores_equal_scoring_each_size(data, model):
    sizes = [1, 20, 200]
    for r in fo.score_sizes(model, data, sizes).collect():
        want = ev.error_metrics(fo.CutForest(model, sizes[r["point"]]).transform(data), "label", "prediction", ["mae", "rmse", "r2_cor"]).head()
        assert [r[c] for c in ("n", "mae", "rmse", "r2_cor")] == pytest.approx([want[c] for c in ("n", "mae", "rmse", "r2_cor")])


def test_search_over_the_full_grid(data):
    got = fo.forest_search(data, fv.FOREST_GRID["mtry"], fv.FOREST_GRID["min_node"], 2, 3, depth=4)
    table = got.table().toPandas()
    assert len(table) == 12 and got.scores.agg(F.sum("n")).head()[0] == 12 * N
    assert table.mae.min() == pytest.approx(table[(table.param_mtry == got.best["mtry"]) & (table.param_min_node == got.best["min_node"])].mae.iloc[0])
    assert ev.error_metrics(got.model.transform(data), "label", "prediction", ["mae"]).head()["mae"] < 2


def test_bag_weights_are_poisson(spark):
    w = spark.range(40_000).select(fo.bag_weight(fo.hashed_mark(["id"])(F.lit(3))).alias("w")).toPandas().w
    assert w.mean() == pytest.approx(1, abs=0.03) and w.var() == pytest.approx(1, abs=0.05) and (w == 0).mean() == pytest.approx(np.exp(-1), abs=0.01)
    edges = spark.createDataFrame([(0.0,), (0.3678,), (0.3679,), (0.7357,), (0.7358,), (0.999999999999,)], "u double")
    assert [r[0] for r in edges.select(fo.bag_weight(F.col("u"))).collect()] == [0, 0, 1, 1, 2, 12]


@pytest.fixture(scope="module")
def bagged(data):
    return fo.bagged_forest(data, COLUMNS, fo.hashed_mark(["id"], 5), 6, 2, depth=6)


def test_out_of_bag_error_by_hand(data, bagged):
    got = fo.out_of_bag_error(bagged, data).head()
    pdf = data.withColumn("bags", bagged._bags()).toPandas()
    ready = VectorAssembler(inputCols=COLUMNS, outputCol="_features").transform(data)
    by_tree = np.column_stack([t.setFeaturesCol("_features").transform(ready).toPandas().set_index("id").loc[pdf.id].prediction for t in bagged.model.trees])
    out = np.array(pdf.bags.tolist()) == 0
    some = out.any(axis=1)
    mean = (by_tree * out)[some].sum(1) / out[some].sum(1)
    error = pdf.label[some] - mean
    assert got["n"] == some.sum() < N and got["mae"] == pytest.approx(error.abs().mean()) and got["rmse"] == pytest.approx((error**2).mean() ** 0.5)
    seen = ev.error_metrics(bagged.transform(data), "label", "prediction", ["rmse"]).head()["rmse"]
    assert seen < got["rmse"] < 3


def test_out_of_bag_importance(data, bagged):
    got = {r["variable"]: r["importance"] for r in fo.out_of_bag_importance(bagged, data, ["id"], bucket_rows=100).collect()}
    assert got["a"] > 5 * got["b"] > 5 * abs(got["c"])


def test_a_tree_does_not_see_the_rows_out_of_its_bag(spark):
    """With one tree, changing the targets of its unseen rows changes nothing."""
    mark = fo.hashed_mark(["id"], 1)
    rows = spark.range(300).withColumns({"a": F.col("id") % 17 * 1.0, "label": F.col("id") % 17 * 2.0})
    odd = rows.withColumn("label", F.when(fo.bag_weight(mark(F.lit(0))) == 0, 1e6).otherwise(F.col("label")))
    a, b = (fo.bagged_forest(t, ["a"], mark, 1, 1, depth=4) for t in (rows, odd))
    np.testing.assert_allclose(*[f.transform(rows).orderBy("id").toPandas().prediction for f in (a, b)])


def test_out_of_bag_importance_by_hand_and_its_shuffles_go(spark, data, bagged):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: sum(f.getName().startswith("shuffle_") for f in (files.apply(i) for files in [disk.getAllFiles()] for i in range(files.size())))
    rows, before = data.repartition(4, "id").localCheckpoint(), shuffles()
    got = {r["variable"]: r["importance"] for r in fo.out_of_bag_importance(bagged, rows, ["id"], bucket_rows=100, seed=7).collect()}
    for _ in range(100):  # files go in the background
        if shuffles() <= before:
            break
        time.sleep(0.1)
    assert shuffles() <= before

    def by_tree(df, ids):
        ready = VectorAssembler(inputCols=COLUMNS, outputCol="_features").transform(df)
        return np.column_stack([t.setFeaturesCol("_features").transform(ready).toPandas().set_index("id").loc[ids].prediction for t in bagged.model.trees])

    pdf = data.withColumn("bags", bagged._bags()).toPandas()
    out, y, own = np.array(pdf.bags.tolist()) == 0, pdf.label.to_numpy()[:, None], by_tree(data, pdf.id)
    # ids decide the bags, so the bags stay with the rows when a column moves
    for i, c in enumerate(COLUMNS):
        moved = by_tree(ev.shuffle_column(data.select("id", *COLUMNS), c, ["id"], N // 100, 7 + 2 * i), pdf.id)
        rise = ((((y - moved) ** 2 - (y - own) ** 2) * out).sum(0) / out.sum(0)).mean()
        assert got[c] == pytest.approx(rise, rel=1e-9, abs=1e-9)


def test_walk_over_ranks_takes_thresholds_and_categories_as_the_model_does(spark):
    from pyspark.ml.feature import StringIndexer
    rows = pd.DataFrame({"kind": [f"k{v}" for v in RNG.integers(0, 6, 500)], "a": RNG.integers(0, 9, 500) / 4})
    rows["label"] = rows.kind.isin(["k1", "k4"]) * 5.0 + rows.a
    df = spark.createDataFrame(rows)
    df = StringIndexer(inputCol="kind", outputCol="k").fit(df).transform(df)
    ready = VectorAssembler(inputCols=["k", "a"], outputCol="features").transform(df).cache()
    model = fo._forest(1, 2, 4, 32, "label", "features", 1).fit(ready)
    nodes = fo.forest_nodes(model)
    walk, pdf = fo._Walk(nodes, 2), model.transform(ready).toPandas()
    assert nodes.categorical.any() and not nodes.categorical.all()
    np.testing.assert_allclose(walk.predict(0, walk.ranks(pdf[["k", "a"]].to_numpy())), pdf.prediction)


def test_rows_of_an_importance_are_packed_once(data, bagged, monkeypatch):
    """Bags and ranks are worked out in one scan, whatever the number of columns."""
    staged, stage = [], fo.stage
    monkeypatch.setattr(fo, "stage", lambda df, name: (staged.append((name, df.count())), stage(df, name))[1])
    got = fo.out_of_bag_importance(bagged, data, ["id"], bucket_rows=100)
    assert staged == [("packed", N)] and got.count() == len(COLUMNS)
