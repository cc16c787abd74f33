"""Random forests searched without refitting, and judged on the rows that a tree did not see.

A node is split or not by the number of its rows, whatever the least size; so a forest grown down to the least size of a grid, cut back
where nodes are smaller, is the forest of every larger size. A grid costs one forest per number of features and fold.

Bags are drawn by a hash of row and tree. The weight of a row in a bag can be worked out again anywhere, so the rows out of a bag are
known without being stored.

A search on rows that a task can hold grows its trees in tasks (`grown`); larger tables are fitted by Spark.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from math import exp, factorial
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotline.operators import grown as gr
from lotline.operators.cells import find_cells
from lotline.operators.models import fits_at_once
from lotline.operators.penalised import SUMS, error_sums, metrics_of_sums
from lotline.operators.tuning import SearchResult, fold_pairs
from lotline.staging import stage, stage_path

_LEAVES = "_leaves"


@dataclass(frozen=True)
class ForestNodes:
    """The nodes of all trees, one tree after the other and each in pre-order, so that leaves come in the order of their numbers."""

    count: np.ndarray
    mean: np.ndarray
    parent: np.ndarray  # row of the parent, -1 for a root
    depth: np.ndarray
    leaf: np.ndarray  # rows of the leaves
    first_leaf: np.ndarray  # per tree, where its leaves begin among them
    root: np.ndarray  # per tree
    children: np.ndarray  # (2, nodes): rows of the left and the right child, a leaf's own row
    feature: np.ndarray  # of the split
    split: list  # threshold of the split in a list of one, or the categories that go left
    categorical: np.ndarray

    def leaf_values(self, min_node: float) -> np.ndarray:
        """Per leaf, the mean of the first node on the way there that has fewer rows than `min_node`, else of the leaf."""
        value, stopped = self.mean.copy(), self.count < min_node
        for d in range(1, int(self.depth.max(initial=0)) + 1):
            rows = np.flatnonzero(self.depth == d)
            above = self.parent[rows]
            value[rows] = np.where(stopped[above], value[above], value[rows])
            stopped[rows] |= stopped[above]
        return value[self.leaf]


def forest_nodes(model: RandomForestRegressionModel) -> ForestNodes:
    """Node counts (of the bag) and means of a fitted forest, by way of its stored form in the shared folder."""
    spark = SparkSession.active()
    path = stage_path(spark, "forest")
    model.write().save(path)
    node = F.col("nodeData")
    table = spark.read.parquet(f"{path}/data").select(
        "treeID", node["id"].alias("id"), F.get(node["impurityStats"], F.lit(0)).alias("count"), node["prediction"].alias("mean"),
        node["leftChild"].alias("left"), node["rightChild"].alias("right"), node["split"]["featureIndex"].alias("feature"),
        node["split"]["leftCategoriesOrThreshold"].alias("split"), node["split"]["numCategories"].alias("categories"),
    ).toPandas().sort_values(["treeID", "id"])
    tree, left, right = (table[c].to_numpy() for c in ("treeID", "left", "right"))
    first = np.searchsorted(tree, np.arange(tree.max() + 1))
    parent, depth = np.full(len(table), -1), np.zeros(len(table), dtype=int)
    level = first
    while len(level):
        inner = level[left[level] >= 0]
        below = [first[tree[inner]] + child[inner] for child in (left, right)]
        for rows in below:
            parent[rows], depth[rows] = inner, depth[inner] + 1
        level = np.concatenate(below)
    leaf = np.flatnonzero(left < 0)
    own = np.arange(len(table))
    children = np.stack([np.where(left < 0, own, first[tree] + child) for child in (left, right)])
    return ForestNodes(
        table["count"].to_numpy(), table["mean"].to_numpy(), parent, depth, leaf, np.searchsorted(tree[leaf], np.arange(tree.max() + 1)),
        first, children, table["feature"].to_numpy(), list(table["split"]), (table["categories"].to_numpy() >= 0) & (left >= 0))


def _leaf_rows(model: RandomForestRegressionModel, df: DataFrame, name: str = _LEAVES) -> DataFrame:
    """Add the numbers of the leaves, one per tree."""
    scored = model.copy({model.leafCol: "_leaf_vector", model.predictionCol: "_forest"}).transform(df)
    return scored.withColumn(name, vector_to_array("_leaf_vector")).drop("_leaf_vector", "_forest")


def _leaf_numbers(column: pa.Array, trees: int, first: np.ndarray) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, trees).astype(np.int64) + first


def score_sizes(model: RandomForestRegressionModel, df: DataFrame, min_nodes: Sequence[float], label: str = "label") -> DataFrame:
    """(point, n, rmse, r2_cor, mae) of the forest cut back to each least size, in one scan; `point` is the place in `min_nodes`."""
    nodes, trees = forest_nodes(model), model.getNumTrees
    sent = df.sparkSession.sparkContext.broadcast((nodes.first_leaf, np.stack([nodes.leaf_values(m) for m in min_nodes])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, values = sent.value
        total = 0
        for batch in batches:
            if batch.num_rows:
                at = _leaf_numbers(batch.column(_LEAVES), trees, first)
                total = total + error_sums(batch.column("y").to_numpy(), np.column_stack([v[at].mean(axis=1) for v in values]))
        if not isinstance(total, int):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values)), pa.int32()), *map(pa.array, total)], ["point", *SUMS])

    rows = _leaf_rows(model, df.where(F.col(label).isNotNull())).select(_LEAVES, F.col(label).cast("double").alias("y"))
    return metrics_of_sums(rows.mapInArrow(run, "point int, " + ", ".join(f"{c} double" for c in SUMS)), "point")


@dataclass
class CutForest:
    """A forest cut back to a least node size; `transform` adds the prediction."""

    model: RandomForestRegressionModel
    min_node: float
    prediction: str = "prediction"

    def transform(self, df: DataFrame) -> DataFrame:
        nodes = forest_nodes(self.model)
        sent = df.sparkSession.sparkContext.broadcast((nodes.first_leaf, nodes.leaf_values(self.min_node)))

        @F.pandas_udf("double")
        def mean(leaves):
            first, values = sent.value
            return leaves.map(lambda x: float(values[x.astype(np.int64) + first].mean()))

        return _leaf_rows(self.model, df).withColumn(self.prediction, mean(_LEAVES)).drop(_LEAVES)


def _forest(trees: int, mtry: int, depth: int, bins: int, label: str, features: str, seed: int, min_child: int = 1) -> RandomForestRegressor:
    return RandomForestRegressor(labelCol=label, featuresCol=features, numTrees=trees, featureSubsetStrategy=str(mtry), maxDepth=depth, maxBins=bins,
                                 minInstancesPerNode=min_child, seed=seed)


def _merged(fitted: Sequence[RandomForestRegressionModel], features: str) -> RandomForestRegressionModel:
    """The forest of the trees of all models."""
    gateway = SparkContext._active_spark_context._gateway
    kind = gateway.jvm.org.apache.spark.ml.regression
    trees = [t for one in fitted for t in one._java_obj.trees()]
    own = gateway.new_array(kind.DecisionTreeRegressionModel, len(trees))
    for t, one in enumerate(trees):
        own[t] = one
    whole = RandomForestRegressionModel(kind.RandomForestRegressionModel(f"merged_{uuid.uuid4().hex[:12]}", own, fitted[0].numFeatures))
    # the mean is taken over the number of trees that the model has as a parameter
    whole._set(numTrees=len(trees)).setFeaturesCol(features)._transfer_params_to_java()
    return whole


BATCH_TREES = 50  # trees that Spark fits at once: it keeps 4 bytes per tree with every row


def _fit_in_batches(learner: RandomForestRegressor, df: DataFrame) -> RandomForestRegressionModel:
    """The learner's forest, so many trees at a time; further batches have seeds of their own."""
    trees, seed = learner.getNumTrees(), learner.getSeed()
    if trees <= BATCH_TREES:
        return learner.fit(df)
    fitted = [learner.copy().setNumTrees(min(BATCH_TREES, trees - at)).setSeed(seed + 1_000_003 * at).fit(df) for at in range(0, trees, BATCH_TREES)]
    return _merged(fitted, learner.getFeaturesCol())


def score_predictions(df: DataFrame, points: int) -> DataFrame:
    """(point, n, rmse, r2_cor, mae) of the predictions p0, p1, ... of `y`."""
    names = [f"p{k}" for k in range(points)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(SUMS), points))
        for batch in batches:
            if batch.num_rows:
                total += error_sums(batch.column("y").to_numpy(), np.column_stack([batch.column(c).to_numpy() for c in names]))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(points), pa.int32()), *map(pa.array, total)], ["point", *SUMS])

    return metrics_of_sums(df.select("y", *names).mapInArrow(run, "point int, " + ", ".join(f"{c} double" for c in SUMS)), "point").where("n > 0")


def forest_search(
    df: DataFrame, mtrys: Sequence[int], min_nodes: Sequence[int], trees: int, k: int, depth: int = 12, bins: int = 32, label: str = "label",
    features: str = "features", metric: str = "mae", roles: DataFrame | None = None, key: str | None = None, seed: int = 0, parallelism: int = 4,
) -> SearchResult:
    """Every number of features and least node size on every fold, from one forest per number of features and fold.

    A node of fewer rows than the least size is not split. More features than there are count as all. Lower is better, but
    for r2_cor; ties go to the earlier point. `df` is best staged before. Fits run side by side as far as their rows stay in memory.
    """
    known = df.where(F.col(label).isNotNull())
    folds = list(fold_pairs(known, k, roles, key))
    least = sorted(set(min_nodes))
    in_tasks = gr.grows_in_tasks(_forest(trees, 1, depth, bins, label, features, seed), df, df.count())

    def learner(mtry: int) -> RandomForestRegressor:
        return _forest(trees, mtry, depth, bins, label, features, seed)

    def prepare(pair):
        train, test = pair
        cells, rows = find_cells(train, features, bins, seed)
        if not rows:
            raise ValueError("a fold has no rows to grow trees on")
        held = stage(test.select(F.monotonically_increasing_id().alias("_row"), F.col(label).cast("double").alias("y"), features), "held_out")
        return gr.binned_rows(train, held, cells, features, label), held.select("_row", "y")

    def score(job):
        mtry, (f, (train, test)) = job
        own = learner(mtry)
        if in_tasks:
            rows, held = binned[f]
            return mtry, f, score_predictions(gr.forest_predictions(rows, own, least, gr.tasks_of(df)).join(held, "_row"), len(least)).orderBy("point").collect()
        return mtry, f, score_sizes(_fit_in_batches(own, train), test, least, label).orderBy("point").collect()

    with ThreadPool(fits_at_once(df, parallelism, 1 - 1 / k, 0 if in_tasks else min(trees, BATCH_TREES))) as pool:
        binned = pool.map(prepare, folds, chunksize=1) if in_tasks else []
        done = pool.map(score, [(m, f) for m in mtrys for f in enumerate(folds)], chunksize=1)
    rows, sums = [], {}
    for mtry, f, scored in done:
        for r in scored:
            rows.append((float(mtry), float(least[r["point"]]), f, r["n"], r["rmse"], r["r2_cor"], r["mae"]))
            if r[metric] is not None:
                sums.setdefault((list(mtrys).index(mtry), r["point"]), []).append(r[metric])
    sign = -1 if metric.startswith("r2") else 1
    i, j = min(sums, key=lambda at: (sign * sum(sums[at]) / len(sums[at]), at))
    scores = df.sparkSession.createDataFrame(rows, "param_mtry double, param_min_node double, fold int, n long, rmse double, r2_cor double, mae double")
    best = gr.GrownForest(learner(mtrys[i]), known, label, least[j]) if in_tasks else CutForest(_fit_in_batches(learner(mtrys[i]), known), least[j])
    return SearchResult(scores, {"mtry": mtrys[i], "min_node": least[j]}, best)


# --- bags --------------------------------------------------------------------------------------

_POISSON = [sum(exp(-1) / factorial(j) for j in range(k + 1)) for k in range(12)]


def hashed_mark(keys: Sequence[str], seed: int = 0) -> Callable[[Column], Column]:
    """A number in [0, 1) per row and tree, from the keys of the row."""
    def mark(tree: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), tree, *keys), F.lit(2**52)) / F.lit(float(2**52))

    return mark


def bag_weight(mark: Column) -> Column:
    """How often a row is drawn into a bag of as many rows as the table has: Poisson with mean one, from a number in [0, 1)."""
    weight = F.lit(len(_POISSON))
    for k, limit in reversed(list(enumerate(_POISSON))):
        weight = F.when(mark < F.lit(limit), F.lit(k)).otherwise(weight)
    return weight


@dataclass
class BaggedForest:
    """A forest whose bags can be worked out again, and its nodes."""

    model: RandomForestRegressionModel
    columns: Sequence[str]
    mark: Callable[[Column], Column]
    trees: int

    def transform(self, df: DataFrame) -> DataFrame:
        ready = VectorAssembler(inputCols=list(self.columns), outputCol="_features").transform(df)
        return self.model.transform(ready).drop("_features")

    def _scored(self, df: DataFrame, name: str) -> DataFrame:
        ready = VectorAssembler(inputCols=list(self.columns), outputCol="_features").transform(df)
        return _leaf_rows(self.model, ready, name).drop("_features")

    def _bags(self) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(self.trees - 1)), lambda t: bag_weight(self.mark(t)))


def bagged_forest(
    df: DataFrame, columns: Sequence[str], mark: Callable[[Column], Column], trees: int, mtry: int, depth: int = 12, min_node: int = 5,
    bins: int = 32, label: str = "label", seed: int = 0, parallelism: int = 4,
) -> BaggedForest:
    """A forest of trees that each have a bag by `mark`, which gives a number in [0, 1) for a row and a tree number.

    Rows without a target or one of the columns take no part. Every tree is a fit of its own; `df` is best staged before.
    """
    known = VectorAssembler(inputCols=list(columns), outputCol="_features", handleInvalid="skip").transform(df.where(F.col(label).isNotNull()))

    def fit(t: int):
        bag = known.withColumn("_bag", bag_weight(mark(F.lit(t))).cast("double")).where("_bag > 0")
        learner = _forest(1, mtry, depth, bins, label, "_features", seed + t, max(1, min_node // 2))
        return learner.setBootstrap(False).setWeightCol("_bag").fit(bag)

    with ThreadPool(fits_at_once(df, parallelism)) as pool:
        fitted = pool.map(fit, range(trees), chunksize=1)
    return BaggedForest(_merged(fitted, "_features"), columns, mark, trees)


def _out_of_bag(bags: pa.Array, trees: int) -> np.ndarray:
    return bags.flatten().to_numpy().reshape(-1, trees) == 0


def out_of_bag_error(forest: BaggedForest, df: DataFrame, label: str = "label") -> DataFrame:
    """One row (n, rmse, r2_cor, mae): each row predicted by the trees that did not see it; rows that every tree saw do not count."""
    nodes, trees = forest_nodes(forest.model), forest.trees
    sent = df.sparkSession.sparkContext.broadcast((nodes.first_leaf, nodes.leaf_values(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, values = sent.value
        total = np.zeros((len(SUMS), 1))
        for batch in batches:
            out = _out_of_bag(batch.column("_bags"), trees)
            some = out.any(axis=1)
            if some.any():
                p = values[_leaf_numbers(batch.column(_LEAVES), trees, first)]
                mean = (p * out).sum(axis=1)[some] / out.sum(axis=1)[some]
                total += error_sums(batch.column("y").to_numpy()[some], mean[:, None])
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), *map(pa.array, total)], ["point", *SUMS])

    known = df.where(F.col(label).isNotNull())
    rows = forest._scored(known, _LEAVES).select(_LEAVES, forest._bags().alias("_bags"), F.col(label).cast("double").alias("y"))
    scored = metrics_of_sums(rows.mapInArrow(run, "point int, " + ", ".join(f"{c} double" for c in SUMS)).where("n > 0"), "point")
    return scored.drop("point")


class _Walk:
    """Trees over ranks: the rank of a value among the thresholds of its feature decides every split as the value does."""

    def __init__(self, nodes: ForestNodes, features: int):
        self.root, self.children, self.mean = nodes.root, nodes.children, nodes.mean
        inner = nodes.children[0] != np.arange(len(nodes.mean))
        self.feature = np.where(inner, nodes.feature, 0)
        self.cuts = [np.unique([nodes.split[r][0] for r in np.flatnonzero(inner & ~nodes.categorical & (nodes.feature == f))]) for f in range(features)]
        self.limit = np.zeros(len(nodes.mean), dtype=np.int64)
        kinds = np.flatnonzero(nodes.categorical)
        self.nominal = set(nodes.feature[kinds].tolist())
        self.kind, self.goes_left = np.full(len(nodes.mean), -1), np.zeros((len(kinds), 1 + int(max((max(nodes.split[r], default=0) for r in kinds), default=0))), dtype=bool)
        for r in np.flatnonzero(inner & ~nodes.categorical):
            self.limit[r] = np.searchsorted(self.cuts[self.feature[r]], nodes.split[r][0])
        for k, r in enumerate(kinds):
            self.kind[r] = k
            self.goes_left[k, np.asarray(nodes.split[r], dtype=int)] = True
        ends = np.r_[self.root[1:], len(nodes.mean)]
        self.depth = [int(nodes.depth[a:b].max()) for a, b in zip(self.root, ends)]
        self.uses = [set(self.feature[a:b][inner[a:b]].tolist()) for a, b in zip(self.root, ends)]
        most = max([len(c) for c in self.cuts], default=0)
        self.dtype = np.dtype(np.uint8 if most < 2**8 and not self.nominal else np.uint16 if most < 2**16 else np.uint32)

    def ranks(self, x: np.ndarray) -> np.ndarray:
        """Columns of the features as ranks; a category is its own rank."""
        return np.stack([x[:, f] if f in self.nominal else np.searchsorted(c, x[:, f]) for f, c in enumerate(self.cuts)], 1).astype(self.dtype)

    def predict(self, tree: int, ranks: np.ndarray) -> np.ndarray:
        at, rows = np.full(len(ranks), self.root[tree]), np.arange(len(ranks))
        for _ in range(self.depth[tree]):
            rank = ranks[rows, self.feature[at]]
            right = rank > self.limit[at]
            if len(self.goes_left):
                own = np.flatnonzero(self.kind[at] >= 0)
                known = rank[own] < self.goes_left.shape[1]
                right[own] = ~(known & self.goes_left[self.kind[at[own]], np.where(known, rank[own], 0)])
            at = self.children[right.astype(np.intp), at]
        return self.mean[at]


def _packed(rows: np.ndarray) -> pa.Array:
    """Rows of bytes as binaries."""
    n, width = rows.shape
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(0, (n + 1) * width, width, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(rows))])


def _unpacked(column: pa.Array, width: int) -> np.ndarray:
    start = column.offset * width
    return np.frombuffer(column.buffers()[2], np.uint8)[start : start + len(column) * width].reshape(-1, width)


def _packed_rows(forest: BaggedForest, walk: _Walk, df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """(keys, _row): in `_row` the target, the ranks of the features and a bit per tree that did not see the row."""
    trees, names = forest.trees, list(dict.fromkeys(keys))
    sent = df.sparkSession.sparkContext.broadcast(walk)
    ready = VectorAssembler(inputCols=list(forest.columns), outputCol="_features").transform(df.where(F.col(label).isNotNull()))
    rows = ready.select(*names, vector_to_array("_features").alias("_x"), forest._bags().alias("_bags"), F.col(label).cast("double").alias("_y"))
    own = ready.select(*names).schema

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if n:
                ranks = sent.value.ranks(batch.column("_x").flatten().to_numpy().reshape(n, -1))
                bits = np.packbits(_out_of_bag(batch.column("_bags"), trees), axis=1)
                y = np.ascontiguousarray(batch.column("_y").to_numpy())[:, None]
                row = _packed(np.hstack([y.view(np.uint8), np.ascontiguousarray(ranks).view(np.uint8), bits]))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), row], [*names, "_row"])

    return rows.mapInArrow(pack, own.add("_row", "binary"))


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def out_of_bag_importance(forest: BaggedForest, df: DataFrame, keys: Sequence[str], label: str = "label", bucket_rows: int = 10_000, seed: int = 0) -> DataFrame:
    """(variable, importance): how much the squared error of a tree on the rows out of its bag rises when a column is shuffled, over all trees.

    A column is shuffled once over all rows, in buckets by `keys`; one scan per column. What moves of a row is its target, the ranks of its
    features among the thresholds of the forest, a bit per tree and two hashes. Columns are worked off one after the other, and the files
    of a shuffle go before the next, so the disk holds those of one column.
    """
    spark, trees = df.sparkSession, forest.trees
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:  # the stored form of a forest is shuffled, too
        walk = _Walk(forest_nodes(forest.model), len(forest.columns))
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    sent, size, features = spark.sparkContext.broadcast(walk), walk.dtype.itemsize, len(forest.columns)
    width = 8 + features * size + -(-trees // 8)
    rows = stage(_packed_rows(forest, walk, df, keys, label), "packed")  # bags and ranks are worked out once, not per column

    def importance(i: int, buckets: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            walk, rise, n = sent.value, np.zeros(trees), np.zeros(trees)
            for batch in batches:
                if not batch.num_rows:
                    continue
                own, other = (_unpacked(batch.column(c), width) for c in ("_row", "_moved"))
                ranks, moved = (np.ascontiguousarray(r[:, 8 : 8 + features * size]).view(walk.dtype) for r in (own, other))
                y, out = np.ascontiguousarray(own[:, :8]).view(np.float64)[:, 0], np.unpackbits(own[:, 8 + features * size :], axis=1, count=trees).astype(bool)
                n += out.sum(axis=0)
                differs = ranks[:, i] != moved[:, i]  # equal ranks end in the same leaf
                for t in range(trees):
                    if i in walk.uses[t]:
                        at = np.flatnonzero(out[:, t] & differs)
                        before, after = ranks[at], ranks[at]
                        after[:, i] = moved[at, i]
                        rise[t] += ((y[at] - walk.predict(t, after)) ** 2 - (y[at] - walk.predict(t, before)) ** 2).sum()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(trees), pa.int32()), pa.array(rise), pa.array(n)], ["tree", "rise", "n"])

        marked = rows.select(
            F.pmod(F.xxhash64(F.lit(seed + 2 * i), *keys), F.lit(buckets)).alias("_bucket"), F.xxhash64(F.lit(seed + 2 * i + 1), *keys).alias("_mark"), "_row")
        inside = Window.partitionBy("_bucket").orderBy("_mark")  # equal keys stay as they come
        whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        moved = marked.select("_row", F.coalesce(F.lead("_row").over(inside), F.first("_row").over(whole)).alias("_moved"))
        per_tree = moved.mapInArrow(run, "tree int, rise double, n double").groupBy("tree").agg(F.sum("rise").alias("rise"), F.sum("n").alias("n"))
        return per_tree.agg(F.avg(F.try_divide("rise", "n"))).head()[0]

    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        buckets = max(1, df.where(F.col(label).isNotNull()).count() // bucket_rows)
        found = [(c, importance(i, buckets)) for i, c in enumerate(forest.columns)]
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.createDataFrame(found, "variable string, importance double")
