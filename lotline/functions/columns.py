"""Projections, filters and scalar expressions on columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_columns(
    df: DataFrame, keep: Sequence[str] | None = None, drop: Sequence[str] = ()
) -> DataFrame:
    """Keep the named columns (all when None), less the dropped ones, in table order of `keep`."""
    gone = set(drop)
    return df.select(*[c for c in (keep or df.columns) if c not in gone])


def column_difference(left: Sequence[str], right: Sequence[str]) -> list[str]:
    """Names in `left` that are not in `right`, order kept."""
    gone = set(right)
    return [c for c in left if c not in gone]


def rename_columns(
    df: DataFrame,
    names: Mapping[str, str] | None = None,
    replace: tuple[str, str] | None = None,
    first: Sequence[str] = (),
) -> DataFrame:
    """Rename by map, then replace text in every name, then move `first` to the front."""
    if names:
        df = df.withColumnsRenamed(dict(names))
    if replace:
        df = df.withColumnsRenamed({c: c.replace(*replace) for c in df.columns})
    if first:
        # names with dots need quoting
        df = df.select(*[f"`{c}`" for c in [*first, *column_difference(df.columns, first)]])
    return df


def rescale(df: DataFrame, divisors: Mapping[str, float]) -> DataFrame:
    """Change units: each named column divided by its number."""
    return df.withColumns({c: F.col(c) / F.lit(float(d)) for c, d in divisors.items()})


def drop_null_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null in any of the columns (in any column at all when None)."""
    return df.na.drop(subset=list(columns) if columns else None)


def within_box(
    x: Column | str, y: Column | str, box: tuple[float, float, float, float]
) -> Column:
    """Closed bounding-box test; `box` is (min x, min y, max x, max y)."""
    x, y = _col(x), _col(y)
    return x.between(box[0], box[2]) & y.between(box[1], box[3])


def not_in(column: Column | str, values: Sequence) -> Column:
    """True where the value is outside the list. Null counts as outside."""
    c = _col(column)
    return c.isNull() | ~c.isin(list(values))


def fill_from(target: Column | str, sources: Sequence[tuple[Column | str, float | None]]) -> Column:
    """Fill nulls of `target` from each source in turn; a source with a minimum counts only above it."""
    parts = [_col(target)]
    for source, minimum in sources:
        s = _col(source)
        parts.append(s if minimum is None else F.when(s > minimum, s))
    return F.coalesce(*parts)


def to_number(column: Column | str) -> Column:
    """Double, or null where the text is no number."""
    return _col(column).try_cast("double")


def two_level_flag(column: Column | str, zero: str, one: str) -> Column:
    """0 for the first level, 1 for the second, null for anything else."""
    c = _col(column)
    return F.when(c == one, 1).when(c == zero, 0)


def case_map(column: Column | str, mapping: Mapping, default=None) -> Column:
    """Value for value replacement."""
    c = _col(column)
    branches = list(mapping.items())
    expr = reduce(
        lambda acc, kv: acc.when(c == kv[0], F.lit(kv[1])),
        branches[1:],
        F.when(c == branches[0][0], F.lit(branches[0][1])),
    )
    return expr.otherwise(F.lit(default)) if default is not None else expr


# target transforms, each with its inverse
TARGET_TRANSFORMS = {
    "identity": (lambda c: c, lambda c: c),
    "log": (F.log, F.exp),
    "log1p": (F.log1p, F.expm1),
}


def round_half_even(column: Column | str, digits: int = 0) -> Column:
    """Rounding with halves going to the even digit."""
    return F.bround(_col(column), digits)


def clip(column: Column | str, low: float, high: float) -> Column:
    """Value held inside [low, high]; null stays null."""
    c = _col(column)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(float(low))), F.lit(float(high))))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
