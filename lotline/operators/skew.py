"""Joins that stay balanced when a few keys hold a large share of the rows.

A key is hot when it has more rows than an even share of one task. Hot keys are counted exactly, by one
aggregate of the keys alone that runs before the join; there are fewer than shuffle partitions, so the driver holds them
and the join reads them as a local table. Only rows of hot keys are dealt to slices, as many as their count asks for,
and only the matching rows of the other side are repeated; without hot keys nothing is dealt. Both sides are compared in
their common type, as a plain join does.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICES = "_slices"
_STORED = {"Project", "Filter", "Relation", "LogicalRDD", "LocalRelation", "Range", "SubqueryAlias"}


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, _slices): keys with more rows than an even share of a task, and into how many slices to deal them."""
    return hot_from_counts(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), keys, "_n")


def hot_from_counts(counts: DataFrame, keys: Sequence[str], weight: str, total: float | None = None) -> DataFrame:
    """The same from a table that has one row per key and its number of rows.

    Every hot key has over one share of all rows, so there are fewer of them than shares and they are among the heaviest
    keys: one job takes as many of these as there are shares, and adds up the total on the way unless it is given.
    """
    parts, seen = _partitions(counts), Observation()
    narrow = counts.select(*keys, F.col(weight).cast("double").alias(SLICES))
    if total is None:
        narrow = narrow.observe(seen, F.sum(SLICES).alias("total"))
    heaviest = narrow.orderBy(F.desc(SLICES)).limit(parts).collect()
    total = seen.get["total"] if total is None and heaviest else total
    share = max((total or 0) / parts, 1.0)
    hot = [(*r[:-1], min(math.ceil(r[SLICES] / share), parts)) for r in heaviest if r[SLICES] is not None and r[SLICES] > share]
    schema = T.StructType([*counts.select(*keys).schema.fields, T.StructField(SLICES, T.IntegerType())])
    return counts.sparkSession.createDataFrame(hot, schema)


def reads_stored_rows(df: DataFrame) -> bool:
    """Whether the rows come straight from a stored table, so that a retry sees them in the same order."""
    plan = df._jdf.queryExecution().analyzed().toString()
    nodes = [line.lstrip(" :+-").split("[")[0].split("(")[0].split() for line in plan.splitlines()]
    return all(n[0] in _STORED for n in nodes if n)


def row_salt(df: DataFrame) -> Column:
    """A number per row that deals rows evenly and is the same on a retry.

    Rows of a stored table are numbered as they are read, so equal rows part too. Elsewhere it is a
    hash of the row and its partition.
    """
    if reads_stored_rows(df):
        return F.monotonically_increasing_id()
    plain = [c for c, t in df.dtypes if not t.startswith(("map", "variant"))]
    return F.xxhash64(F.spark_partition_id(), *[F.col(f"`{c}`") for c in plain])


def _common_types(left: DataFrame, right: DataFrame, on: Sequence[str]) -> list[str]:
    """The type in which each key is compared; analysis only."""
    a = left.select(*[F.col(c).alias(f"l{i}") for i, c in enumerate(on)])
    b = right.select(*[F.col(c).alias(f"r{i}") for i, c in enumerate(on)])
    both = a.join(b, F.lit(False), "full").select(*[F.coalesce(f"l{i}", f"r{i}").alias(f"k{i}") for i in range(len(on))])
    return [t for _, t in both.dtypes]


def _equal(a: Sequence[str], b: Sequence[str], null_safe: bool) -> Column:
    one = (lambda x, y: F.col(x).eqNullSafe(F.col(y))) if null_safe else (lambda x, y: F.col(x) == F.col(y))
    return reduce(lambda x, y: x & y, [one(x, y) for x, y in zip(a, b)])


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    hot: DataFrame | None = None,
    spread: bool | int = False,
) -> DataFrame:
    """Equi-join with the hot keys of `left` spread over many tasks.

    `how` is inner, left, left_semi or left_anti: those decide each left row by itself, so the
    left side may be sliced. With `null_safe`, null keys match each other. `hot`, a table as
    of `hot_keys` where one is at hand, saves counting the keys of `left`. `spread` is for joins that make many
    pairs out of few bytes: the left side is hash-partitioned on the join keys into the full number
    of shuffle partitions, or as many as given if that is more, which a sort-merge join needs anyway and
    small-partition merging would undo.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot slice the left side of a {how} join")
    on, own = list(on), left.columns
    kinds = _common_types(left, right, on)
    lk, rk, hk = ([f"_{side}{i}" for i in range(len(on))] for side in "lrh")
    salt = row_salt(left)
    left = left.withColumns({n: F.col(c).cast(t) for n, c, t in zip(lk, on, kinds)})
    right = right.withColumns({n: F.col(c).cast(t) for n, c, t in zip(rk, on, kinds)}).drop(*on)
    hot = hot_keys(left, lk).toDF(*hk, SLICES) if hot is None else hot.select(
        *[F.col(c).cast(t).alias(n) for n, c, t in zip(hk, on, kinds)], SLICES
    )
    equal = _equal(lk, rk, null_safe)
    slices = [] if hot.isEmpty() else ["_ls"]
    if slices:
        left, right = _dealt(left, right, F.broadcast(hot), salt, (lk, rk, hk), null_safe)
        equal = equal & (F.col("_ls") == F.col("_rs"))
    if spread:
        left = left.repartition(max(_partitions(left), int(spread)), *lk, *slices)
    out = left.join(right, equal, how)
    if how in ("left_semi", "left_anti"):
        return out.select(*own)
    return out.select(*on, *[c for c in own if c not in on], *[c for c in right.columns if c not in (*rk, "_rs")])


def _dealt(
    left: DataFrame, right: DataFrame, hot: DataFrame, salt: Column, names: tuple[list[str], list[str], list[str]], null_safe: bool
) -> tuple[DataFrame, DataFrame]:
    """The left rows of hot keys with a slice each (_ls), the right ones repeated for every slice (_rs)."""
    lk, rk, hk = names
    # a null key matches no row of the other side, but its rows have to be dealt out as well
    dealt = F.when(F.col(SLICES).isNotNull(), F.pmod(F.col("_salt"), F.col(SLICES))).otherwise(0)
    left = left.withColumn("_salt", salt).join(hot, _equal(lk, hk, True), "left")
    left = left.withColumn("_ls", dealt.cast("int")).drop(*hk, SLICES, "_salt")
    right = right.join(hot, _equal(rk, hk, null_safe), "left")
    right = right.withColumn("_rs", F.explode(F.sequence(F.lit(0), F.coalesce(F.col(SLICES), F.lit(1)) - 1))).drop(*hk, SLICES)
    return left, right


def outer_merge(left: DataFrame, right: DataFrame, on: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Full outer join on shared keys: the left join plus the right rows that found no partner."""
    on = list(on)
    matched = skew_join(left, right, on, "left", null_safe)
    lone = skew_join(right, left.select(*on).distinct(), on, "left_anti", null_safe)
    return matched.unionByName(lone, allowMissingColumns=True)
