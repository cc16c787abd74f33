"""Regression trees pruned by cost complexity.

A tree is grown once, without a limit on its complexity; weakest-link pruning then gives the nested sequence of its best
subtrees, and so the tree for every value of the complexity parameter. Scoring needs one aggregate over the held-out
rows: deviations from the mean of every node on the way to their leaf. The size of the grid costs nothing more.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline.operators.models import fits_at_once
from lotline.operators.tuning import SearchResult, fold_pairs

_LEAF = "_leaf"


@dataclass
class Node:
    """A node of a grown tree: its rows, mean and summed squares about the mean, and where it splits."""

    number: int
    n: float
    mean: float
    risk: float
    depth: int
    parent: int | None
    children: tuple[int, int] | None = None
    feature: int | None = None
    threshold: float | None = None
    # the complexity from which on the node is a leaf; below it, it splits
    collapse: float = 0.0


@dataclass
class GrownTree:
    """The nodes of a fitted tree in pre-order, which is also the order in which Spark numbers leaves."""

    model: DecisionTreeRegressionModel
    nodes: list[Node] = field(default_factory=list)

    def leaves(self) -> list[Node]:
        return [t for t in self.nodes if t.children is None]

    def path(self, leaf: Node) -> list[Node]:
        """From the root to a leaf."""
        out = [leaf]
        while out[-1].parent is not None:
            out.append(self.nodes[out[-1].parent])
        return out[::-1]

    def node_at(self, leaf: Node, cp: float) -> Node:
        """The node that a row of this leaf ends in once the tree is pruned to `cp`."""
        limit = cp * self.nodes[0].risk
        return next((t for t in self.path(leaf) if t.children is None or t.collapse <= limit), leaf)

    def size(self, cp: float) -> int:
        """Leaves of the pruned tree."""
        return len({self.node_at(leaf, cp).number for leaf in self.leaves()})

    def sequence(self) -> list[tuple[float, int, float]]:
        """(cp, leaves, relative error) of each tree of the nested sequence, from the root on: each row holds from its cp up to the one before."""
        root = self.nodes[0].risk
        cuts = sorted({t.collapse / root for t in self.nodes if t.children is not None} | {0.0}, reverse=True) if root else [0.0]
        out = []
        for cp in cuts:
            kept = {self.node_at(leaf, cp).number for leaf in self.leaves()}
            out.append((cp, len(kept), sum(self.nodes[k].risk for k in kept) / root if root else 0.0))
        return out


def grown(model: DecisionTreeRegressionModel) -> GrownTree:
    """Nodes and collapse points of a fitted tree, read on the driver: a tree is small."""
    tree = GrownTree(model)

    def visit(node, depth: int, parent: int | None) -> int:
        stats = node.impurityStats()
        number, n = len(tree.nodes), float(stats.count())
        tree.nodes.append(Node(number, n, float(node.prediction()), float(node.impurity()) * n, depth, parent))
        if node.getClass().getSimpleName() == "InternalNode":
            split, own = node.split(), tree.nodes[number]
            own.feature = split.featureIndex()
            own.threshold = float(split.threshold()) if split.getClass().getSimpleName() == "ContinuousSplit" else None
            own.children = (visit(node.leftChild(), depth + 1, number), visit(node.rightChild(), depth + 1, number))
        return number

    visit(model._java_obj.rootNode(), 0, None)
    mark_collapses(tree.nodes)
    return tree


def mark_collapses(nodes: list[Node]) -> None:
    """Weakest-link pruning: again and again the split that lowers the risk least per leaf becomes a leaf, at the rate it lowered it by.

    A split below a node that has gone before it collapses with it; rates never fall along the way.
    """
    live = {t.number for t in nodes if t.children is not None}
    last = 0.0
    while live:
        risk: dict[int, float] = {}
        leaves: dict[int, int] = {}
        for t in reversed(nodes):  # children come after their parent
            if t.number in live:
                a, b = t.children
                risk[t.number], leaves[t.number] = risk[a] + risk[b], leaves[a] + leaves[b]
            else:
                risk[t.number], leaves[t.number] = t.risk, 1
        rates = {k: (nodes[k].risk - risk[k]) / (leaves[k] - 1) for k in live}
        weakest = min(rates.values())
        last = max(last, weakest)
        # links that are equally weak but for rounding go at once
        for k in [k for k, r in rates.items() if r <= weakest + 1e-12 * nodes[0].risk]:
            for t in _below(nodes, k):
                if t in live:
                    nodes[t].collapse = last
                    live.discard(t)


def _below(nodes: list[Node], number: int) -> list[int]:
    out, todo = [], [number]
    while todo:
        k = todo.pop()
        out.append(k)
        todo += nodes[k].children or ()
    return out


@dataclass
class PrunedTree:
    """A grown tree cut back to a complexity; `transform` adds the prediction."""

    tree: GrownTree
    cp: float
    prediction: str = "prediction"

    def transform(self, df: DataFrame) -> DataFrame:
        means = [self.tree.node_at(leaf, self.cp).mean for leaf in self.tree.leaves()]
        scored = _with_leaf(self.tree, df)
        return scored.withColumn(self.prediction, F.get(_numbers(means), F.col(_LEAF))).drop(_LEAF)


def _numbers(values: Sequence[float]) -> Column:
    """A literal array; written as one string, which the optimizer folds, since a tree may have thousands of leaves."""
    return F.split(F.lit(",".join(map(repr, map(float, values)))), ",").cast("array<double>")


def _with_leaf(tree: GrownTree, df: DataFrame) -> DataFrame:
    """Add the number of the leaf that each row falls into."""
    model = tree.model.copy({tree.model.leafCol: _LEAF, tree.model.predictionCol: "_tree"})
    return model.transform(df).drop("_tree").withColumn(_LEAF, F.col(_LEAF).cast("int"))


def grow(df: DataFrame, min_node: int = 20, depth: int = 10, bins: int = 64, label: str = "label", features: str = "features") -> GrownTree:
    """A tree without a limit on its complexity."""
    learner = DecisionTreeRegressor(
        labelCol=label, featuresCol=features, maxDepth=depth, minInstancesPerNode=min_node, maxBins=bins, minInfoGain=0.0, seed=0)
    return grown(learner.fit(df))


def node_deviations(tree: GrownTree, df: DataFrame, label: str) -> dict[int, dict]:
    """Per leaf: rows, sum and squares of the target, and absolute deviations from the mean of every node on the way, by depth."""
    leaves = tree.leaves()
    deepest = max(leaf.depth for leaf in leaves)
    means = {d: [] for d in range(deepest + 1)}
    for leaf in leaves:
        way = tree.path(leaf)
        for d in means:
            means[d].append(way[min(d, leaf.depth)].mean)
    y = F.col(label).cast("double")
    rows = _with_leaf(tree, df).groupBy(_LEAF).agg(
        F.count(y).alias("n"), F.sum(y).alias("y1"), F.sum(y * y).alias("y2"),
        *[F.sum(F.abs(y - F.get(_numbers(m), F.col(_LEAF)))).alias(f"d{d}") for d, m in means.items()],
    ).collect()
    return {r[_LEAF]: r.asDict() for r in rows}


def scores_by_cp(tree: GrownTree, held_out: Mapping[int, dict], cps: Sequence[float]) -> list[dict]:
    """n, rmse, r2_cor and mae of the tree pruned to each complexity, from the sums of `node_deviations`."""
    out = []
    for cp in cps:
        n = e1 = e2 = y1 = y2 = p1 = p2 = py = 0.0
        for number, leaf in enumerate(tree.leaves()):
            own = held_out.get(number)
            if own is None or not own["n"]:
                continue
            node = tree.node_at(leaf, cp)
            n, y1, y2 = n + own["n"], y1 + own["y1"], y2 + own["y2"]
            e1, e2 = e1 + own[f"d{node.depth}"], e2 + own["y2"] - 2 * node.mean * own["y1"] + node.mean**2 * own["n"]
            p1, p2, py = p1 + own["n"] * node.mean, p2 + own["n"] * node.mean**2, py + node.mean * own["y1"]
        if not n:
            out.append({"n": 0, "rmse": None, "r2_cor": None, "mae": None})
            continue
        spread, other = p2 / n - (p1 / n) ** 2, y2 / n - (y1 / n) ** 2
        flat = spread <= 1e-13 * p2 / n or other <= 1e-13 * y2 / n
        r2 = None if flat else (py / n - p1 * y1 / n**2) ** 2 / (spread * other)
        out.append({"n": int(n), "rmse": max(0.0, e2 / n) ** 0.5, "r2_cor": r2, "mae": e1 / n})
    return out


def tree_search(
    df: DataFrame, cps: Sequence[float], k: int, min_node: int = 20, depth: int = 10, bins: int = 64, label: str = "label",
    metric: str = "mae", roles: DataFrame | None = None, key: str | None = None, parallelism: int = 3,
) -> SearchResult:
    """Every complexity on every fold from one tree per fold; the best one, and the tree of all rows pruned to it.

    Ties go to the earlier complexity. A fold without training or held-out rows is left out. `df` is best staged before. The trees of the folds and of all
    rows grow side by side as far as their rows stay in memory.
    """
    rows, sums = [], {i: [] for i in range(len(cps))}
    known = df.where(F.col(label).isNotNull())

    def scored(pair):
        train, test = pair
        if train.isEmpty() or test.isEmpty():
            return []
        tree = grow(train, min_node, depth, bins, label)
        return scores_by_cp(tree, node_deviations(tree, test, label), cps)

    with ThreadPool(fits_at_once(df, parallelism)) as pool:
        last = pool.apply_async(lambda: None if known.isEmpty() else grow(known, min_node, depth, bins, label))
        done = pool.map(scored, list(fold_pairs(known, k, roles, key)), chunksize=1)
        whole = last.get()
    for fold, found in enumerate(done):
        for i, score in enumerate(found):
            rows.append((float(cps[i]), fold, score["n"], score["rmse"], score["r2_cor"], score["mae"]))
            if score[metric] is not None:
                sums[i].append(score[metric])
    sign = -1 if metric.startswith("r2") else 1
    best = min((i for i in sums if sums[i]), key=lambda i: (sign * sum(sums[i]) / len(sums[i]), i))
    scores = df.sparkSession.createDataFrame(rows, "param_cp double, fold int, n long, rmse double, r2_cor double, mae double")
    return SearchResult(scores, {"cp": cps[best]}, PrunedTree(whole, float(cps[best])))
