"""Distance joins between two sets of boxes, by descent through a pair of grids.

Both sides are summed up into grid cells (row count, weight, tight bounding box of the contents).
Pairs of cells are then refined level by level; a pair whose boxes prove that no row in it can
matter is dropped, one that proves that every row matters is counted whole. Only cell tables take
part in this, and they stay small. Rows meet rows at the last level alone, in the pairs that are
still undecided. The descent goes on until the undecided row pairs are no more than some hundred
per row, so dense spots and clusters far from everything are refined as deep as they need.

Points are boxes of no extent. Every table here has box columns x1, y1, x2, y2 and a weight w.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotline.operators.skew import _partitions, hot_from_counts, skew_join
from lotline.staging import stage, stage_observed

FIRST_LEVEL = 4
STEP = 1
LAST_LEVEL = 26
PAIRS_PER_ROW = 128
# what one task sorts: pairs of cells, pairs of rows
CELL_PAIRS_PER_TASK = 1_000_000
ROW_PAIRS_PER_TASK = 2_000_000

BOX = ["x1", "y1", "x2", "y2"]


@dataclass(frozen=True)
class Frame:
    """Square that holds both sides, and their row counts."""

    x0: float
    y0: float
    side: float
    rows: int

    def cell(self, level: int, box: Sequence[str] = BOX) -> list[Column]:
        """Cell numbers of a box, by its middle."""
        x1, y1, x2, y2 = (F.col(c) for c in box)
        last = F.lit(2**level - 1)
        return [
            F.greatest(F.least(F.floor((mid - F.lit(o)) / F.lit(self.side) * (2.0**level)), last), F.lit(0))
            .cast("int")
            for mid, o in (((x1 + x2) / 2, self.x0), ((y1 + y2) / 2, self.y0))
        ]


@dataclass(frozen=True)
class Side:
    """A staged table of boxes and what was seen of it while it was written."""

    df: DataFrame
    seen: dict

    @property
    def rows(self) -> int:
        return self.seen["n"] or 0

    @cached_property
    def hot(self) -> DataFrame:
        """(x1, y1) of the places with a large share of the rows, as of `hot_keys`; found once."""
        return hot_from_counts(self.df, ["x1", "y1"], "w", self.seen["wsum"] or 0)


def make_side(df: DataFrame, name: str = "places") -> Side:
    return Side(*stage_observed(df, name, {
        "n": F.count(F.lit(1)), "wsum": F.sum("w"), "wmax": F.max("w"),
        "x0": F.min("x1"), "y0": F.min("y1"), "x9": F.max("x2"), "y9": F.max("y2"),
    }))


def make_frame(a: Side, b: Side) -> Frame | None:
    """None when a side has no rows."""
    if not a.rows or not b.rows:
        return None
    x0, y0 = (min(s.seen[c] for s in (a, b)) for c in ("x0", "y0"))
    x9, y9 = (max(s.seen[c] for s in (a, b)) for c in ("x9", "y9"))
    side = max(x9 - x0, y9 - y0) * (1 + 1e-9) or 1.0
    return Frame(float(x0), float(y0), float(side), a.rows + b.rows)


def _cells(t: DataFrame, frame: Frame, level: int, side: str, apart: str | None) -> DataFrame:
    i, j = frame.cell(level)
    split = F.lit(0) if apart is None else F.col(apart)
    return t.groupBy(i.alias(f"{side}i"), j.alias(f"{side}j"), split.alias(f"{side}g")).agg(
        F.count(F.lit(1)).alias(f"{side}n"), F.sum("w").alias(f"{side}w"),
        F.min("x1").alias(f"{side}x1"), F.min("y1").alias(f"{side}y1"),
        F.max("x2").alias(f"{side}x2"), F.max("y2").alias(f"{side}y2"),
    )


def _gap(lo1, hi1, lo2, hi2) -> Column:
    return F.greatest(F.lit(0.0), lo1 - hi2, lo2 - hi1)


def _span(lo1, hi1, lo2, hi2) -> Column:
    return F.greatest(hi1 - lo2, hi2 - lo1)


def box_bounds(a: Sequence[str], b: Sequence[str]) -> tuple[Column, Column]:
    """Least and greatest squared distance between points of two boxes."""
    a, b = [F.col(c) for c in a], [F.col(c) for c in b]
    near = [_gap(a[k], a[k + 2], b[k], b[k + 2]) for k in (0, 1)]
    far = [_span(a[k], a[k + 2], b[k], b[k + 2]) for k in (0, 1)]
    return near[0] * near[0] + near[1] * near[1], far[0] * far[0] + far[1] * far[1]


A_BOX, B_BOX = ([f"{s}{c}" for c in BOX] for s in "ab")
A_KEY, B_KEY = ["ai", "aj", "ag"], ["bi", "bj", "bg"]


def _dealing(keys: Sequence[str], apart: str | None) -> list[str]:
    """The cell keys without the group where all rows are of one.

    Joins drop a constant key, so rows dealt by it as well would be shuffled once more, into as few tasks as bytes ask for.
    """
    return [k for k in keys if apart is not None or not k.endswith("g")]


def _children(pairs: DataFrame | None, a: DataFrame, b: DataFrame, step: int, tasks: int, apart: str | None) -> DataFrame:
    """Pairs of child cells under the surviving pairs of parents, with the bound `pfar2` of these; made in so many tasks.

    The first level hangs under a single root pair, at most 4^FIRST_LEVEL cells on each side.
    """
    def parent(t: DataFrame, side: str) -> DataFrame:
        return t.withColumns({
            f"p{side}i": F.shiftright(f"{side}i", step), f"p{side}j": F.shiftright(f"{side}j", step)
        })

    a, b = parent(a, "a"), parent(b, "b")
    if pairs is None:
        both = a.join(b, (F.col("pai") == F.col("pbi")) & (F.col("paj") == F.col("pbj")))
        return both.withColumn("pfar2", F.lit(math.inf))
    parents = pairs.select(*[F.col(c).alias(f"p{c}") for c in [*A_KEY, *B_KEY, "far2"]])
    parents = parents.withColumnsRenamed({"pag": "ag", "pbg": "bg"}).repartition(tasks, *_dealing(["pai", "paj", "ag"], apart))
    return parents.join(a, ["pai", "paj", "ag"]).join(b, ["pbi", "pbj", "bg"])


@dataclass
class Descent:
    """Undecided cell pairs at the last level, and what was decided on the way."""

    frame: Frame
    level: int
    pairs: DataFrame
    whole: list[tuple[int, DataFrame]]
    work: float
    cell_pairs: int
    apart: str | None = None

    def group(self) -> Column:
        return F.lit(0) if self.apart is None else F.col(self.apart)

    def by(self, keys: Sequence[str]) -> list[str]:
        return _dealing(keys, self.apart)


def _descend(a: DataFrame, b: DataFrame, frame: Frame, sift: Callable, apart: str | None = None) -> Descent:
    """Refine until few row pairs are undecided or the last level is reached.

    `sift` takes pairs with bounds near2 and far2 and a number of tasks and returns (undecided, counted whole or None). The far2 that it
    leaves on a pair bounds all pairs of cells under it that matter. Few cells make many pairs, so tasks go by the pairs and not by bytes.
    """
    pairs, whole, level, step = None, [], FIRST_LEVEL, FIRST_LEVEL
    tasks = _partitions(a)
    while True:
        both = _children(pairs, _cells(a, frame, level, "a", apart), _cells(b, frame, level, "b", apart), step, tasks, apart)
        if apart is not None:
            both = both.where("ag <> bg")
        near2, far2 = box_bounds(A_BOX, B_BOX)
        kept, done = sift(both.withColumns({"near2": near2, "far2": far2}).where("near2 <= pfar2").drop("pfar2"), tasks)
        keep = A_KEY + B_KEY + ["an", "bn", "bw", *B_BOX, "far2"]
        tagged = kept.select(*keep, F.lit(False).alias("whole"))
        if done is not None:
            tagged = tagged.unionByName(done.select(*keep, F.lit(True).alias("whole")))
        undecided = F.when(~F.col("whole"), F.col("an").cast("double") * F.col("bn"))
        tagged, seen = stage_observed(tagged, "cells", {
            "work": F.sum(undecided), "whole": F.count_if("whole"), "pairs": F.count_if(~F.col("whole")),
        })
        pairs = tagged.where(~F.col("whole"))
        if seen["whole"]:
            whole.append((level, tagged.where("whole").groupBy(*A_KEY, "bg").agg(F.sum("bw").alias("w"))))
        work, open_pairs = seen["work"] or 0.0, seen["pairs"] or 0
        if work <= PAIRS_PER_ROW * frame.rows or level >= LAST_LEVEL:
            return Descent(frame, level, pairs, whole, work, open_pairs, apart)
        step = min(STEP, LAST_LEVEL - level)
        level += step
        tasks = max(1, math.ceil(open_pairs * 16**step / CELL_PAIRS_PER_TASK))


def _hot(found: Descent, keys: Sequence[str], weight: Column) -> DataFrame:
    """Hot cells among the undecided pairs."""
    return hot_from_counts(found.pairs.groupBy(*keys).agg(weight.alias("n")), keys, "n")


def _row_candidates(a: DataFrame, found: Descent) -> DataFrame:
    """Rows of `a` next to the cells of `b` they have to be compared with."""
    i, j = found.frame.cell(found.level)
    by = found.by(A_KEY)
    rows = a.withColumns({k: c for k, c in zip(A_KEY, (i, j, found.group())) if k in by})
    hot = _hot(found, by, F.max("an"))
    cells = found.pairs.select(*A_KEY, *B_KEY, "bw", *B_BOX, F.col("far2").alias("cell_far2"))
    near = skew_join(rows, cells, by, "inner", hot=hot, spread=math.ceil(found.cell_pairs / CELL_PAIRS_PER_TASK))
    near2, far2 = box_bounds(BOX, B_BOX)
    return near.withColumns({"near2": near2, "far2": far2})


def _with_rows(candidates: DataFrame, b: DataFrame, found: Descent, columns: Sequence[str]) -> DataFrame:
    """Candidates joined with the rows of their cells; `b` columns get the prefix b_."""
    i, j = found.frame.cell(found.level)
    by = found.by(B_KEY)
    own = [c.alias(k) for k, c in zip(B_KEY, (i, j, found.group())) if k in by]
    rows = b.select(*own, *[F.col(c).alias(f"b_{c}") for c in columns])
    return skew_join(candidates, rows, by, "inner", hot=_hot(found, by, F.sum("an")),
                     spread=max(1, math.ceil(found.work / ROW_PAIRS_PER_TASK)))


def nearest(
    a: Side, b: Side, distance2: Column, payload: Sequence[str], columns: Sequence[str] = ()
) -> DataFrame:
    """For each distinct row of `a` (x1, y1, x2, y2): least (d2, payload...) over all rows of `b`.

    `distance2` is an expression over the columns of `a` and those of `b` with prefix b_.
    Ties go to the lowest payload. Rows of `a` are kept only when `b` has rows.
    """
    best = F.struct(F.col("d2"), *[F.col(f"b_{c}").alias(c) for c in payload])
    frame, a, b = make_frame(a, b), a.df, b.df
    if frame is None:
        none = b.select(*[F.col(c).alias(f"b_{c}") for c in payload], F.lit(0.0).alias("d2"))
        return none.select(*[F.lit(0.0).alias(c) for c in BOX], best.alias("best")).limit(0)

    def sift(pairs, tasks):
        reach = F.min("far2").over(Window.partitionBy(*A_KEY))
        kept = pairs.repartition(tasks, *_dealing(A_KEY, None)).withColumn("reach", reach).where("near2 <= reach")
        return kept.withColumn("far2", F.col("reach")), None

    found = _descend(a, b, frame, sift)
    close = _row_candidates(a, found).where("near2 <= cell_far2")
    pairs = _with_rows(close, b, found, [*payload, *columns])
    return pairs.withColumn("d2", distance2).groupBy(*BOX).agg(F.min(best).alias("best"))


def weight_within(
    a: Side, b: Side, radius: float, distance2: Column,
    keys: Sequence[str] = BOX, columns: Sequence[str] = (), apart: str | None = None,
    sift: Callable | None = None,
) -> DataFrame:
    """For each row of `a` (told apart by `keys`): total weight w of `b` rows within the radius.

    Rows of `a` without any are left out. With `apart`, a column of both sides, only rows that
    differ in it are compared, and there is one line per row of `a` and value bg on the other side.
    """
    r2 = float(radius) ** 2
    frame, a, b = make_frame(a, b), a.df, b.df
    if frame is None:
        bg = F.lit(0) if apart is None else F.col(apart)
        return a.select(*keys, bg.alias("bg"), F.lit(0).cast("long").alias("w")).limit(0)

    def decided_by_pair(pairs, tasks):
        reach = pairs.where(F.col("near2") <= r2)
        return reach.where(F.col("far2") > r2), reach.where(F.col("far2") <= r2)

    found = _descend(a, b, frame, sift or decided_by_pair, apart)
    near = _row_candidates(a, found).where(F.col("near2") <= r2)
    exact = (
        _with_rows(near.where(F.col("far2") > r2).drop("w", "bw", *B_BOX), b, found, ["w", *columns])
        .where(distance2 <= r2)
        .select(*keys, "bg", F.col("b_w").alias("w"))
    )
    by_cell = near.where(F.col("far2") <= r2).select(*keys, "bg", F.col("bw").alias("w"))
    total = exact.unionByName(by_cell)
    if found.whole:
        total = total.unionByName(_whole_weights(a, found, keys))
    return total.groupBy(*keys, "bg").agg(F.sum("w").cast("long").alias("w"))


def any_within(
    a: Side, b: Side, radius: float, distance2: Column,
    keys: Sequence[str] = BOX, columns: Sequence[str] = (), apart: str | None = None,
) -> DataFrame:
    """Rows of `a` (and values bg of `apart`) with at least one row of `b` within the radius.

    One cell that lies wholly within the radius settles all rows of a cell of `a`, and cells that
    cannot hold the nearest row are dropped, so far fewer pairs stay open than in a count.
    """
    r2 = float(radius) ** 2

    def sift(pairs, tasks):
        reach = F.min("far2").over(Window.partitionBy(*A_KEY, "bg"))
        close = pairs.where(F.col("near2") <= r2).repartition(tasks, *_dealing([*A_KEY, "bg"], apart)).withColumn("reach", reach)
        settled = (F.col("reach") <= r2) & (F.col("far2") == F.col("reach"))
        return close.where((F.col("reach") > r2) & (F.col("near2") <= F.col("reach"))), close.where(settled)

    found = weight_within(a, b, radius, distance2, keys, columns, apart, sift)
    return found.select(*keys, "bg")


def _whole_weights(a: DataFrame, found: Descent, keys: Sequence[str]) -> DataFrame:
    """Weights counted by whole cells, brought down to the last level and on to the rows."""
    i, j = found.frame.cell(found.level)
    cells = a.groupBy(i.alias("ai"), j.alias("aj"), found.group().alias("ag")).agg(F.count(F.lit(1)).alias("an"))
    base = None
    for level, weights in found.whole:
        up = found.level - level
        below = cells.withColumns({"ki": F.shiftright("ai", up), "kj": F.shiftright("aj", up)})
        weights = weights.withColumnsRenamed({"ai": "ki", "aj": "kj"})
        part = below.join(weights, ["ki", "kj", "ag"]).drop("ki", "kj")
        base = part if base is None else base.unionByName(part)
    base = base.groupBy(*A_KEY, "bg").agg(F.sum("w").alias("w"), F.max("an").alias("an"))
    base = stage(base, "whole")
    hot = hot_from_counts(base.groupBy(*A_KEY).agg(F.max("an").alias("an")), A_KEY, "an")
    rows = a.select(*keys, i.alias("ai"), j.alias("aj"), found.group().alias("ag"))
    return skew_join(rows, base.drop("an"), A_KEY, "inner", hot=hot).select(*keys, "bg", "w")
