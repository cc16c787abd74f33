"""Duplicates, latest rows, samples and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lotline.operators.skew import hot_from_counts, skew_join
from lotline.staging import stage


def flag_duplicates(df: DataFrame, keys: Sequence[str], name: str = "dup") -> DataFrame:
    """Add 1 where the key values occur more than once, else 0; nulls count as equal.

    Counting is a map-side aggregate; only keys that repeat are staged, and they tell the hot ones too. The
    flags go back by a join with hot keys spread out.
    """
    seen = Observation()
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).observe(seen, F.sum(name).alias("rows"))
    repeated = stage(counts.where(F.col(name) > 1), "repeated")
    hot = hot_from_counts(repeated, keys, name, seen.get["rows"] or 0)
    flags = repeated.withColumn(name, F.lit(1))
    return skew_join(df, flags, keys, "left", null_safe=True, hot=hot).fillna(0, [name])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first in the given order. Nulls in keys form one group.

    An aggregate and not a ranking window: each task keeps only its best row per key, so a key
    with a third of all rows costs no more than any other. Order columns may be descending
    (`F.col("year").desc()`); rows equal in all of them fall to the smallest whole row.
    """
    rest = [c for c in df.columns if c not in set(keys)]
    if not rest:
        return df.distinct()
    best = F.struct(*[_ascending(df, o).alias(f"o{i}") for i, o in enumerate(order)], *rest)
    picked = df.groupBy(*keys).agg(F.min(best).alias("row"))
    return picked.select(*[c if c in set(keys) else F.col("row")[c].alias(c) for c in df.columns])


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    newest: Sequence[str] = ("year", "month"),
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """The newest row of every key: highest values of `newest`, then lowest tie-break."""
    order = [Descending(c) for c in newest] + list(tie_break)
    return first_per_key(df, keys, order)


class Descending(str):
    """Name of a numeric order column to be taken from high to low, nulls last."""


def _ascending(df: DataFrame, order: Column | str) -> Column:
    if isinstance(order, Descending):
        c = F.col(order)
        return F.struct(c.isNull().alias("none"), (-c).alias("value"))
    c = F.col(order) if isinstance(order, str) else order
    return F.struct(c.isNull().alias("none"), c.alias("value"))


def top_k(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """First k rows in an order; every task keeps k rows."""
    return df.orderBy(*order).limit(k)


def preview(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return top_k(df, n, key)


def sample_rows(
    df: DataFrame, n: int, keys: Sequence[str], seed: int = 0, mark: Column | None = None
) -> DataFrame:
    """Random sample of exactly n rows (all when fewer): those with the n smallest marks.

    The mark is a seeded hash of the keys unless given; the same rows come out however the table is partitioned.
    """
    mark = F.xxhash64(F.lit(seed), *keys) if mark is None else mark
    return df.withColumn("_mark", mark).orderBy("_mark", *keys).limit(n).drop("_mark")


def append_tagged(tables: Mapping[str, DataFrame], tag: str = "base") -> DataFrame:
    """Stack tables of the same columns, each row tagged with its table's name."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)


def reassemble(*parts: DataFrame) -> DataFrame:
    """Stack parts of a split table; columns missing in a part become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def id_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).subtract(right.select(key))


def id_intersection(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).intersect(right.select(key))


def id_union(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).union(right.select(key)).distinct()
