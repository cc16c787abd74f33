"""Profiles, summaries, tests and distribution tables."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotline.operators.quantiles import exact_quantiles, right_closed_bin


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def frequency_table(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: type, rows, nulls, share filled, and mean, sd, min, max where numeric. One pass."""
    columns = list(columns or df.columns)
    numeric, kinds = set(numeric_columns(df)), dict(df.dtypes)
    stats = {}
    for i, c in enumerate(columns):
        v = F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")
        stats |= {
            f"n{i}": F.count(c), f"mean{i}": F.avg(v), f"sd{i}": F.stddev_samp(v),
            f"min{i}": F.min(v), f"max{i}": F.max(v),
        }
    row = df.agg(F.count(F.lit(1)).alias("rows"), *[e.alias(k) for k, e in stats.items()])
    lines = [
        F.struct(
            F.lit(c).alias("variable"), F.lit(kinds[c]).alias("type"), F.col("rows"),
            (F.col("rows") - F.col(f"n{i}")).alias("nulls"),
            F.try_divide(f"n{i}", "rows").alias("complete"),
            *[F.col(f"{k}{i}").alias(k) for k in ("mean", "sd", "min", "max")],
        )
        for i, c in enumerate(columns)
    ]
    return row.select(F.inline(F.array(*lines)))


def describe_all(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Mean, sd, min, quartiles and max of every numeric column; nulls left out."""
    columns = list(columns or numeric_columns(df))
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    row = df.agg(*[
        e.alias(f"{k}{i}")
        for i, c in enumerate(columns)
        for k, e in (
            ("mean", F.avg(c)), ("sd", F.stddev_samp(c)),
            ("min", F.min(c).cast("double")), ("max", F.max(c).cast("double")),
        )
    ])
    lines = []
    for i, c in enumerate(columns):
        p25, p50, p75 = (F.lit(q).cast("double") for q in quartiles[c] or [None] * 3)
        lines.append(F.struct(
            F.lit(c).alias("variable"), F.col(f"mean{i}").alias("mean"), F.col(f"sd{i}").alias("sd"),
            F.col(f"min{i}").alias("min"), p25.alias("p25"), p50.alias("p50"), p75.alias("p75"),
            F.col(f"max{i}").alias("max"),
        ))
    return row.select(F.inline(F.array(*lines)))


def six_numbers(df: DataFrame, column: str) -> DataFrame:
    """Minimum, quartiles, mean and maximum of one column, and its null count."""
    q = exact_quantiles(df, [column], [0.25, 0.5, 0.75])[column] or [None] * 3
    return df.agg(
        F.min(column).cast("double").alias("min"),
        F.lit(q[0]).cast("double").alias("p25"), F.lit(q[1]).cast("double").alias("median"),
        F.avg(column).alias("mean"), F.lit(q[2]).cast("double").alias("p75"),
        F.max(column).cast("double").alias("max"),
        F.count_if(F.col(column).isNull()).alias("nulls"),
    )


def to_long(df: DataFrame, ids: Sequence[str], variable: str = "variable", value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), None, variable, value)


def to_wide(df: DataFrame, ids: Sequence[str], names: str, values: str, levels: Sequence[str]) -> DataFrame:
    """Long to wide; the levels are given, so no extra pass looks for them."""
    return df.groupBy(*ids).pivot(names, list(levels)).agg(F.first(values))


def grouped_means(df: DataFrame, groups: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*groups).agg(*[F.avg(c).alias(c) for c in columns])


def table_shape(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table, and rows relative to the first."""
    parts = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), "rows", F.lit(len(df.columns)).alias("columns")
        )
        parts = one if parts is None else parts.unionByName(one)
    first = next(iter(tables.values())).agg(F.count(F.lit(1)).alias("n"))
    return parts.withColumn("ratio", F.col("rows") / first.scalar())


def error_by_quantile_bin(
    df: DataFrame, observed: str, predicted: str, bins: int = 10
) -> DataFrame:
    """Errors by quantile bin of the target; bins are right-closed, the minimum is in bin 1.

    Rows without a target are in no bin (null); without any target they are the only group.
    """
    breaks = exact_quantiles(df, [observed], [i / bins for i in range(bins + 1)])[observed]
    error = F.abs(F.col(observed) - F.col(predicted))
    number = F.lit(None).cast("int") if breaks is None else right_closed_bin(observed, breaks)
    return (
        df.withColumn("bin", number)
        .groupBy("bin")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(observed).alias("mean_observed"),
            F.avg(predicted).alias("mean_predicted"),
            F.avg(error).alias("mae"),
            (F.avg(F.try_divide(error, F.abs(observed))) * 100).alias("mape"),
        )
    )


def group_moments(df: DataFrame, group: str, variables: Sequence[str]) -> DataFrame:
    """Count, mean and sample variance per variable and group, one pass."""
    row = df.groupBy(group).agg(*[
        e.alias(f"{k}{i}")
        for i, c in enumerate(variables)
        for k, e in (("n", F.count(c)), ("mean", F.avg(c)), ("var", F.var_samp(c)))
    ])
    lines = [
        F.struct(F.lit(c).alias("variable"), *[F.col(f"{k}{i}").alias(k) for k in ("n", "mean", "var")])
        for i, c in enumerate(variables)
    ]
    return row.select(F.col(group), F.inline(F.array(*lines)))


def equal_means_test(moments: DataFrame) -> DataFrame:
    """One-way F statistic per variable from group moments (equal variances); null for one group, or no row beyond the groups."""
    pooled = moments.withColumns({
        "s": F.col("n") * F.col("mean"),
        "within": F.coalesce((F.col("n") - 1) * F.col("var"), F.lit(0.0)),
        "sq": F.col("n") * F.col("mean") * F.col("mean"),
    }).where("n > 0")
    sums = pooled.groupBy("variable").agg(
        F.count(F.lit(1)).alias("groups"), F.sum("n").alias("n"), F.sum("s").alias("s"),
        F.sum("sq").alias("sq"), F.sum("within").alias("within"),
    )
    between = F.col("sq") - F.col("s") * F.col("s") / F.col("n")
    return sums.select(
        "variable",
        (F.col("groups") - 1).alias("df1"),
        (F.col("n") - F.col("groups")).alias("df2"),
        F.try_divide(
            F.try_divide(between, F.col("groups") - 1), F.try_divide(F.col("within"), F.col("n") - F.col("groups"))
        ).alias("f"),
    )


def chi_square_test(df: DataFrame, category: str, group: str) -> DataFrame:
    """Chi-square statistic of a category against a group; 2 by 2 tables get Yates' correction."""
    cells = df.where(F.col(category).isNotNull() & F.col(group).isNotNull())
    counts = cells.groupBy(category, group).agg(F.count(F.lit(1)).alias("o"))
    rows = counts.groupBy(category).agg(F.sum("o").alias("row_total"))
    cols = counts.groupBy(group).agg(F.sum("o").alias("col_total"))
    total = counts.agg(F.sum("o")).scalar()
    # sum over cells of o^2/e needs only the cells that occur; the absent ones add -e each,
    # which the total already has: sum((o-e)^2/e) = sum(o^2/e) - n
    e = F.col("row_total") * F.col("col_total") / F.col("n")
    joined = counts.join(rows, category).join(cols, group).withColumn("n", total)
    plain = joined.agg(
        (F.sum(F.col("o") * F.col("o") / e) - F.max("n")).alias("plain"),
        F.min(F.abs(F.col("o") - e)).alias("gap"),
        F.sum(1 / e).alias("inverse"),
        F.countDistinct(category).alias("r"),
        F.countDistinct(group).alias("c"),
        F.count(F.lit(1)).alias("cells"),
        F.max("n").alias("n"),
    )
    yates = F.least(F.lit(0.5), F.col("gap"))
    corrected = F.pow(F.col("gap") - yates, 2) * F.col("inverse")
    two_by_two = (F.col("r") == 2) & (F.col("c") == 2) & (F.col("cells") == 4)
    return plain.select(
        F.lit(category).alias("variable"),
        ((F.col("r") - 1) * (F.col("c") - 1)).alias("df1"),
        F.when(two_by_two, corrected).otherwise(F.col("plain")).alias("chi2"),
    )


def _upper_tail(spark: SparkSession, family: str, value: float, *parameters: float) -> float:
    """P(X > value) of a distribution of the mathematics library that Spark runs with."""
    distributions = spark._jvm.org.apache.commons.math3.distribution
    return 1.0 - getattr(distributions, family)(*[float(p) for p in parameters]).cumulativeProbability(float(value))


def equal_means_p_values(moments: DataFrame) -> dict[str, float | None]:
    """p-value per variable from the one-way F statistics of group moments; None without a second group or any spread."""
    return {
        r["variable"]: None if r["f"] is None or not r["df1"] else _upper_tail(moments.sparkSession, "FDistribution", r["f"], r["df1"], r["df2"])
        for r in equal_means_test(moments).collect()
    }


def chi_square_p_value(df: DataFrame, category: str, group: str) -> float | None:
    """p-value of `chi_square_test`; None for a single row or column."""
    test = chi_square_test(df, category, group).head()
    if test is None or not test["df1"]:
        return None
    return _upper_tail(df.sparkSession, "ChiSquaredDistribution", test["chi2"], test["df1"])


def balance_table(
    df: DataFrame, group: str, levels: Sequence[str], numeric: Sequence[str], categories: Sequence[str] = ()
) -> DataFrame:
    """Per variable: n, mean and sd by group with the p-value of equal means; for categories the
    count and per cent of each level by group with the chi-square p-value.

    The moments of all numeric variables come from one scan, the counts of a category from one aggregate. A listed
    level without rows has n 0 and null shares.
    """
    moments = group_moments(df, group, numeric)
    wide = moments.groupBy("variable").pivot(group, list(levels)).agg(
        F.coalesce(F.first("n"), F.lit(0)).alias("n"), F.first("mean").alias("mean"), F.sqrt(F.first("var")).alias("sd")
    )
    wide = wide.withColumns({f"{v}_n": F.coalesce(f"{v}_n", F.lit(0)) for v in levels})
    p = equal_means_p_values(moments)
    known = F.create_map(*[F.lit(x) for v in numeric for x in (v, p.get(v))]) if numeric else F.lit(None)
    out = wide.withColumns({"p": known[F.col("variable")].cast("double"), "level": F.lit(None).cast("string")})
    for c in categories:
        counts = df.where(F.col(c).isNotNull()).groupBy(c, group).agg(F.count(F.lit(1)).alias("n"))
        table = counts.groupBy(c).agg(*[
            F.coalesce(F.sum(F.when(F.col(group) == v, F.col("n"))), F.lit(0)).alias(f"{v}_n") for v in levels
        ])
        shares = {}
        for v in levels:
            total = table.agg(F.sum(f"{v}_n")).scalar()
            shares |= {
                f"{v}_n": F.col(f"{v}_n"), f"{v}_mean": F.try_divide(F.col(f"{v}_n") * 100.0, total), f"{v}_sd": F.lit(None).cast("double"),
            }
        out = out.unionByName(table.select(
            F.lit(c).alias("variable"), F.col(c).cast("string").alias("level"), *[e.alias(k) for k, e in shares.items()],
            F.lit(chi_square_p_value(df, c, group)).cast("double").alias("p"),
        ))
    return out.select("variable", "level", *[c for c in out.columns if c not in ("variable", "level")])


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Counts in equal-width bins from minimum to maximum; the maximum is in the last bin."""
    c = F.col(column).cast("double")
    low, high = df.agg(F.min(c), F.max(c)).head()
    if low is None:
        return df.select(F.lit(0).alias("bin"), F.lit(0.0).alias("left"), F.lit(0).alias("n")).limit(0)
    width = (high - low) / bins or 1.0
    number = F.least(F.floor((c - F.lit(low)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    counts = df.where(c.isNotNull()).groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("bin", (F.lit(low) + F.col("bin") * F.lit(width)).alias("left"), "n")


def rule_of_thumb_bandwidth(sd: float, iqr: float, n: int) -> float:
    """0.9 times the smaller of sd and IQR/1.34, times n to the power -1/5."""
    spread = min(sd, iqr / 1.34) or sd or 1.0
    return 0.9 * spread * n ** -0.2


def density(
    df: DataFrame, column: str, points: int = 512, bandwidth: float | None = None
) -> DataFrame:
    """Gaussian kernel density on an even grid from minimum to maximum.

    A column without values gives no rows; one value alone gives one grid point, at the top of its kernel.

    Rows are first shared out linearly between their two neighbouring grid points, which is one
    map-side aggregate to at most `points` rows; the kernel is then summed over the grid alone.
    """
    c = F.col(column).cast("double")
    low, high, n, sd = df.agg(F.min(c), F.max(c), F.count(c), F.stddev_samp(c)).head()
    if not n:
        return df.sparkSession.createDataFrame([], "point int, x double, density double")
    if bandwidth is None:
        q1, q3 = exact_quantiles(df, [column], [0.25, 0.75])[column]
        bandwidth = rule_of_thumb_bandwidth(sd or 0.0, q3 - q1, n)
    if low == high or points < 2:
        peak = 1 / (bandwidth * math.sqrt(2 * math.pi))
        return df.sparkSession.createDataFrame([(0, low, peak)], "point int, x double, density double")
    step = (high - low) / (points - 1)
    spot = (c - F.lit(low)) / F.lit(step)
    left = F.least(F.floor(spot), F.lit(points - 2))
    ends = F.array(
        F.struct(left.alias("i"), (1 - (spot - left)).alias("w")),
        F.struct((left + 1).alias("i"), (spot - left).alias("w")),
    )
    mass = df.where(c.isNotNull()).select(F.inline(ends)).groupBy("i").agg(F.sum("w").alias("w"))
    grid = F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    z = (F.col("g") - F.col("i")) * F.lit(step / bandwidth)
    kernel = F.exp(-z * z / 2) / F.lit(bandwidth * math.sqrt(2 * math.pi) * n)
    return (
        mass.select("i", "w", grid.alias("g"))
        .groupBy("g")
        .agg(F.sum(F.col("w") * kernel).alias("density"))
        .select(F.col("g").alias("point"), (F.lit(low) + F.col("g") * F.lit(step)).alias("x"), "density")
    )


def qq_table(df: DataFrame, column: str, points: int = 99) -> DataFrame:
    """Sample quantiles against standard normal ones at (i - 1/2)/points; null samples for a column without values."""
    probs = [(i - 0.5) / points for i in range(1, points + 1)]
    sample = exact_quantiles(df, [column], probs)[column] or [None] * points
    normal = NormalDist()
    rows = [(i, p, normal.inv_cdf(p), s) for i, (p, s) in enumerate(zip(probs, sample), 1)]
    return df.sparkSession.createDataFrame(rows, "point int, p double, theoretical double, sample double")


def quantile_table(df: DataFrame, column: str, probabilities: Sequence[float]) -> DataFrame:
    values = exact_quantiles(df, [column], probabilities)[column] or [None] * len(probabilities)
    rows = [(float(p), v) for p, v in zip(probabilities, values)]
    return df.sparkSession.createDataFrame(rows, "p double, value double")


def with_scalar(df: DataFrame, name: str, aggregate: Column, source: DataFrame | None = None) -> DataFrame:
    """Add a whole-table aggregate to each row, as a scalar subquery and not as a join."""
    return df.withColumn(name, (source or df).agg(aggregate).scalar())
