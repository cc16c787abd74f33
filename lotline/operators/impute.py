"""Statistics fitted on one table and applied to any other."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import ROUND_HALF_EVEN, Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline.operators.quantiles import exact_median


@dataclass(frozen=True)
class FillModel:
    """Constants that replace nulls, column by column."""

    values: Mapping[str, float | str | None]

    def transform(self, df: DataFrame) -> DataFrame:
        known = {c: v for c, v in self.values.items() if v is not None}
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in known.items()})


def fit_median(df: DataFrame, columns: Sequence[str]) -> FillModel:
    """Exact medians (the mean of the middle two for an even count)."""
    return FillModel(exact_median(df, columns))


def fit_mode(df: DataFrame, columns: Sequence[str]) -> FillModel:
    """Most frequent values; the lowest wins a tie.

    Counted per value first, so no task ever holds all values of a column.
    """
    values = {}
    for c in columns:
        counts = df.where(F.col(c).isNotNull()).groupBy(c).count()
        best = counts.orderBy(F.desc("count"), F.asc(c)).limit(1).head()
        values[c] = best and best[c]
    return FillModel(values)


@dataclass(frozen=True)
class TrimModel:
    """Closed interval for one column."""

    column: str
    low: float
    high: float

    def transform(self, df: DataFrame) -> DataFrame:
        return df.where(F.col(self.column).between(self.low, self.high))


def round_half_even(value: float, digits: int) -> float:
    return float(Decimal(repr(value)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_EVEN))


def fit_sd_trim(
    df: DataFrame, column: str, sds: float = 2, low_digits: int = 2, high_digits: int = 0
) -> TrimModel:
    """Mean plus and minus `sds` sample standard deviations, the bounds rounded."""
    mean, sd = df.agg(F.avg(column), F.stddev_samp(column)).head()
    low = round_half_even(mean - sds * sd, low_digits)
    high = round_half_even(mean + sds * sd, high_digits)
    return TrimModel(column, low, high)
