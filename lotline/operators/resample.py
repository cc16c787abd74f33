"""Splits and folds: random, by strata of the target, and by blocks in space.

Random choices are functions of row keys, so they do not depend on how a table is partitioned.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline.operators import grid
from lotline.operators.quantiles import exact_quantiles, order_statistics, right_closed_bin
from lotline.operators.skew import skew_join
from lotline.operators.spatial import _point_d2
from lotline.staging import stage



def random_mark(keys: Sequence[str], seed: int) -> Column:
    """Row number in a random order."""
    return F.xxhash64(F.lit(seed), *keys)


def _lowest(
    df: DataFrame, marks: Mapping[str, Column], share: Callable[[int], int], tie: Column | None = None
) -> dict[str, Column]:
    """Per name: whether a row is among the `share(n)` of the n rows with the lowest marks.

    Marks are compared in their own type. Where equal marks lie across the cut, `tie` decides among them, a hash of
    the row by default; rows equal in that too stay together.
    """
    found, counts = order_statistics(df, marks, lambda _, n: [share(n) - 1] if share(n) > 0 else [])
    edges = {name: next(iter(found[name].values()), None) for name in marks}
    known = {name: e for name, e in edges.items() if e is not None}
    out = {name: F.lit(False) for name in marks}
    if not known:
        return out
    seen = df.agg(*[
        e.alias(f"{k}{i}") for i, (name, edge) in enumerate(known.items())
        for k, e in (("below", F.count_if(marks[name] < F.lit(edge))), ("on", F.count_if(marks[name] == F.lit(edge))))
    ]).head()
    tie = F.xxhash64(*df.columns) if tie is None else tie
    open_ties = {}
    for i, (name, edge) in enumerate(known.items()):
        room = share(counts[name]) - seen[f"below{i}"]
        out[name] = F.coalesce(marks[name] <= F.lit(edge), F.lit(False))
        if room < seen[f"on{i}"]:
            open_ties[name] = room
    if open_ties:
        on = {name: F.when(marks[name] == F.lit(known[name]), tie) for name in open_ties}
        cuts, _ = order_statistics(df, on, lambda name, _: [open_ties[name] - 1])
        for name in open_ties:
            cut = next(iter(cuts[name].values()))
            out[name] = F.coalesce((marks[name] < F.lit(known[name])) | (on[name] <= F.lit(cut)), F.lit(False))
    return out


def hold_out(df: DataFrame, share: float, mark: Column, tie: Column | None = None) -> DataFrame:
    """Add `held_out`: 1 for the given share of the rows, those with the lowest marks; `tie` parts equal marks."""
    chosen = _lowest(df, {"mark": mark}, lambda n: math.floor(n * share), tie)["mark"]
    return df.withColumn("held_out", chosen.cast("int"))


def last_rows_held_out(df: DataFrame, share: float, order: str) -> DataFrame:
    """Add `held_out`: 1 for the last share of the rows in the order of a numeric key."""
    return hold_out(df, share, -F.col(order))


def stratified_split(
    df: DataFrame, target: str, share: float, mark: Column, breaks: int = 5, tie: Column | None = None
) -> DataFrame:
    """Add `in_train`: in each quantile group of the target the share (rounded up) with the lowest marks.

    `breaks` quantile points cut breaks-1 groups; equal points are merged.
    """
    points = exact_quantiles(df, [target], [i / (breaks - 1) for i in range(breaks)])[target]
    if points is None:
        return df.withColumns({"stratum": F.lit(None).cast("int"), "in_train": F.lit(0)})
    stratum = right_closed_bin(target, points)
    strata = {str(k): F.when(stratum == k, mark) for k in range(1, len(set(points)))}
    chosen = F.lit(False)
    for test in _lowest(df, strata, lambda n: math.ceil(n * share), tie).values():
        chosen = chosen | test
    return df.withColumns({"stratum": stratum, "in_train": chosen.cast("int")})


def random_folds(
    df: DataFrame, k: int, keys: Sequence[str] = (), seed: int = 0, mark: Column | None = None
) -> DataFrame:
    """Add `fold` 0..k-1 by a random mark: a given whole number, or a hash of the keys."""
    mark = random_mark(keys, seed) if mark is None else mark
    return df.withColumn("fold", F.pmod(mark, F.lit(k)).cast("int"))


# --- blocks ----------------------------------------------------------------------------------


def square_cells(
    df: DataFrame, size: float | None = None, cells: int = 10, x: str = "x", y: str = "y"
) -> DataFrame:
    """Add block numbers cx, cy of squares: of the given size, or `cells` by `cells` over the extent."""
    x0, y0, x9, y9 = df.agg(F.min(x), F.min(y), F.max(x), F.max(y)).head()
    if x0 is None:
        return df.withColumns({"cx": F.lit(None).cast("long"), "cy": F.lit(None).cast("long")})
    wide, high = (size, size) if size else ((x9 - x0) / cells or 1.0, (y9 - y0) / cells or 1.0)

    def number(c, low, step):
        n = F.floor((F.col(c) - F.lit(low)) / F.lit(float(step)))
        return n if size else F.least(n, F.lit(cells - 1).cast("long"))

    return df.withColumns({"cx": number(x, x0, wide), "cy": number(y, y0, high)})


def hexagon_cells(df: DataFrame, size: float, x: str = "x", y: str = "y") -> DataFrame:
    """Add axial block numbers cx, cy of pointy-topped hexagons, `size` between opposite edges."""
    radius = size / math.sqrt(3)
    q = (F.col(x) * F.lit(math.sqrt(3) / 3) - F.col(y) / 3) / F.lit(radius)
    r = (F.col(y) * F.lit(2 / 3)) / F.lit(radius)
    s = -q - r
    rq, rr, rs = F.rint(q), F.rint(r), F.rint(s)
    dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs - s)
    # the coordinate that was rounded most is put right from the other two
    fix_q = (dq > dr) & (dq > ds)
    fix_r = ~fix_q & (dr > ds)
    return df.withColumns({
        "cx": F.when(fix_q, -rr - rs).otherwise(rq).cast("long"),
        "cy": F.when(fix_r, -rq - rs).otherwise(rr).cast("long"),
    })


def block_folds(df: DataFrame, k: int, order: Column | None = None, seed: int = 0) -> DataFrame:
    """Add `fold` 0..k-1: blocks (cx, cy) in a random order, cut into k runs of equally many blocks.

    The cuts are k-1 exact order statistics of the random mark, so the fold of a row is a plain
    expression: no ranking of the blocks, no join back.
    """
    mark = random_mark(["cx", "cy"], seed) if order is None else order
    blocks = stage(df.where("cx is not null").select("cx", "cy").distinct(), "blocks")
    found, _ = order_statistics(
        blocks, {"mark": mark}, lambda _, n: [math.ceil(n * j / k) - 1 for j in range(1, k)]
    )
    cuts = sorted(found["mark"].values())
    fold = sum(((mark > F.lit(c)).cast("int") for c in cuts), F.lit(0))
    return df.withColumn("fold", F.when(F.col("cx").isNotNull(), fold))


def balanced_block_folds(
    df: DataFrame, k: int, tries: int = 100, deal: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Add `fold`: of many random deals of the blocks, the one with the most even fold sizes.

    `deal` makes a fold number 0..k-1 from cx, cy and the number of the try. All tries are scored in
    one aggregate over the block counts.
    """
    deal = deal or (lambda t: F.pmod(F.xxhash64(t, F.col("cx"), F.col("cy")), F.lit(k)))
    blocks = df.where("cx is not null").groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n"))
    attempt = blocks.withColumn("try", F.explode(F.sequence(F.lit(0), F.lit(tries - 1))))
    sizes = attempt.groupBy("try", deal(F.col("try")).alias("fold")).agg(F.sum("n").alias("n"))
    # the sizes of a try add up to all rows, so the most even try has the least sum of squares
    spread = sizes.groupBy("try").agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("sq"))
    best = spread.orderBy("sq", "try").limit(1).head()
    chosen = F.lit(0 if best is None else best["try"])
    return df.withColumn("fold", F.when(F.col("cx").isNotNull(), deal(chosen).cast("int")))


def fold_roles(
    df: DataFrame, k: int, key: str, buffer: float = 0.0, x: str = "x", y: str = "y"
) -> DataFrame:
    """Long table (key, fold, role): `test` in a row's own fold, `train` in the others.

    With a buffer, a row is left out of the training rows of a fold that has a row within the buffer.
    """
    roles = df.select(
        key, F.col(x).cast("double").alias("px"), F.col(y).cast("double").alias("py"),
        F.col("fold").alias("own"), F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("fold"),
    ).withColumn("role", F.when(F.col("own") == F.col("fold"), "test").otherwise("train"))
    if not buffer:
        return roles.select(key, "fold", "role")
    at = [F.col(x).cast("double").alias("x1"), F.col(y).cast("double").alias("y1")]
    spots = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*at, "fold").agg(F.count(F.lit(1)).alias("w"))
    side = grid.make_side(spots.select(
        "x1", "y1", F.col("x1").alias("x2"), F.col("y1").alias("y2"), "w", "fold"), "spots")
    near = grid.any_within(side, side, buffer, _point_d2(), ["x1", "y1", "fold"], ["x1", "y1"], apart="fold")
    close = near.select(
        F.col("x1").alias("px"), F.col("y1").alias("py"), F.col("fold").alias("own"), F.col("bg").alias("fold"))
    test = roles.where("role = 'test'")
    train = skew_join(roles.where("role = 'train'"), close, ["px", "py", "own", "fold"], "left_anti")
    return test.unionByName(train).select(key, "fold", "role")
