import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from lotline import fixed_values as fv
from lotline.operators import evaluate as ev
from lotline.operators import pruning as pr

RNG = np.random.default_rng(21)
N = 900


@pytest.fixture(scope="module")
def data(spark):
    x = RNG.integers(0, 30, (N, 3)).astype(float)
    y = np.where(x[:, 0] > 12, 10, 0) + np.where(x[:, 1] > 20, 5, 0) * (x[:, 0] > 12) + 0.1 * x[:, 2] + RNG.normal(0, 1, N)
    pdf = pd.DataFrame(x, columns=list("abc")).assign(label=y, fold=np.arange(N) % 4)
    df = spark.createDataFrame(pdf).withColumn("fold", F.col("fold").cast("int"))
    return VectorAssembler(inputCols=list("abc"), outputCol="features").transform(df).cache()


@pytest.fixture(scope="module")
def tree(data):
    return pr.grow(data, min_node=30, depth=4)


def subtrees(tree, number=0):
    """Every set of leaves that a pruned tree can have."""
    node = tree.nodes[number]
    yield (number,)
    if node.children:
        for a, b in itertools.product(*(list(subtrees(tree, c)) for c in node.children)):
            yield a + b


def test_nodes_are_those_of_the_model(data, tree):
    assert len(tree.nodes) == tree.model.numNodes and len(tree.leaves()) > 6
    rows = pr._with_leaf(tree, data).groupBy(pr._LEAF).agg(F.count("label").alias("n"), F.avg("label").alias("m"), F.var_pop("label").alias("v")).collect()
    for r in rows:
        leaf = tree.leaves()[r[pr._LEAF]]
        assert (leaf.n, leaf.mean) == (r["n"], pytest.approx(r["m"]))
        assert leaf.risk == pytest.approx(r["v"] * r["n"])
    for t in tree.nodes:
        if t.children:
            a, b = (tree.nodes[c] for c in t.children)
            assert t.n == a.n + b.n and t.mean == pytest.approx((a.n * a.mean + b.n * b.mean) / t.n)


def test_pruned_tree_is_the_best_of_all_subtrees(tree):
    """For each complexity no other subtree has a lower cost, and none with that cost is smaller."""
    every = list(subtrees(tree))
    root = tree.nodes[0].risk
    for cp in [0.0, 1e-4, 0.001, 0.003, 0.01, 0.05, 0.2, 0.9, *[c * 1.0001 for c, _, _ in tree.sequence()]]:
        kept = {tree.node_at(leaf, cp).number for leaf in tree.leaves()}
        cost = lambda s: sum(tree.nodes[k].risk for k in s) + cp * root * len(s)
        best = min(map(cost, every))
        assert cost(kept) == pytest.approx(best, rel=1e-9)
        assert len(kept) <= min(len(s) for s in every if cost(s) <= best * (1 + 1e-12))


def test_sequence_is_nested(tree):
    rows = tree.sequence()
    assert rows[0][1:] == (1, pytest.approx(1.0)) and rows[-1][0] == 0
    assert [r[1] for r in rows] == sorted(r[1] for r in rows) and [r[2] for r in rows] == sorted((r[2] for r in rows), reverse=True)
    for cp, leaves, _ in rows:
        assert tree.size(cp) == leaves


def test_scores_equal_scoring_every_pruned_tree(data, tree):
    test = data.where("fold = 1")
    cps = [0.0, 0.002, 0.01, 0.05, 0.5, 1.0]
    for cp, got in zip(cps, pr.scores_by_cp(tree, pr.node_deviations(tree, test, "label"), cps)):
        want = ev.error_metrics(pr.PrunedTree(tree, cp).transform(test), "label", "prediction", ["mae", "rmse", "r2_cor"]).head()
        assert (got["n"], got["mae"], got["rmse"]) == (want["n"], pytest.approx(want["mae"]), pytest.approx(want["rmse"]))
        # the root alone predicts one number for all
        assert got["r2_cor"] is None if tree.size(cp) == 1 else got["r2_cor"] == pytest.approx(want["r2_cor"])


def test_search_over_the_full_grid(data):
    got = pr.tree_search(data, fv.TREE_CP_GRID, 4, min_node=20, depth=6)
    assert got.scores.count() == 31 * 4 and got.scores.agg(F.sum("n")).head()[0] == 31 * N
    table = got.table().toPandas()
    assert got.best["cp"] == table.sort_values(["mae", "param_cp"]).param_cp.iloc[0]
    mae = ev.error_metrics(got.model.transform(data), "label", "prediction", ["mae"]).head()["mae"]
    assert mae < 1.2


def test_constant_target_and_missing_targets(spark, data):
    flat = data.withColumn("label", F.lit(3.0))
    tree = pr.grow(flat)
    assert len(tree.nodes) == 1 and tree.sequence() == [(0.0, 1, 0.0)]
    got = pr.tree_search(flat.withColumn("label", F.when(F.col("a") > 3, 3.0)), [0.0, 0.01], 5)  # fold 4 has no rows
    assert {(r["mae"], r["r2_cor"]) for r in got.scores.collect()} == {(0.0, None)} and got.best == {"cp": 0.0}
    assert got.scores.select("fold").distinct().count() == 4
