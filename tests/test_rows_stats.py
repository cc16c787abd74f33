import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lotline.operators import impute as im
from lotline.operators import quantiles as qn
from lotline.operators import rows as rw
from lotline.operators import skew
from lotline.operators import stats as st

RNG = np.random.default_rng(11)


def history(spark):
    rows = [("a", 1.0, 2019, 5, 1), ("a", 1.0, 2021, 1, 2), ("a", 1.0, 2021, 3, 3), (None, None, 2020, 1, 4),
            (None, None, 2020, 2, 5), ("b", None, 2020, 2, 6), ("b", None, 2020, 2, 7)]
    return spark.createDataFrame(rows, "k string, v double, year int, month int, id int")


def test_duplicates_and_latest(spark):
    df = history(spark)
    assert {r["id"]: r["dup"] for r in rw.flag_duplicates(df, ["k", "v"]).collect()} == {i: 1 for i in range(1, 8)}
    one = rw.flag_duplicates(df, ["k", "v", "month"]).collect()
    assert {r["id"]: r["dup"] for r in one} == {1: 0, 2: 0, 3: 0, 4: 0, 5: 0, 6: 1, 7: 1}
    got = {r["id"] for r in rw.latest_per_key(df, ["k", "v"], tie_break=["id"]).collect()}
    assert got == {3, 5, 6}
    assert {r["id"] for r in rw.first_per_key(df, ["k", "v"], ["year", "month"]).collect()} == {1, 4, 6}


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(1000)
    a = {r["id"] for r in rw.sample_rows(df, 50, ["id"], 3).collect()}
    assert len(a) == 50 and a == {r["id"] for r in rw.sample_rows(df.repartition(64), 50, ["id"], 3).collect()}


def skewed(spark, n=3000):
    key = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 500)
    return spark.range(n).select("id", key.alias("k"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_plain_join(spark, how):
    left = skewed(spark)
    right = spark.range(-1, 250).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    right = right.unionByName(right.where("k < 5"))
    assert [r["k"] for r in skew.hot_keys(left, ["k"]).collect()] == [-1]
    got = skew.skew_join(left, right, ["k"], how)
    want = left.join(right, ["k"], how).select(got.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


@pytest.mark.parametrize(("a", "b"), [
    ("int", "bigint"), ("bigint", "int"), ("float", "double"), ("decimal(10,2)", "double"),
    ("decimal(10,2)", "decimal(12,4)"), ("date", "timestamp"), ("string", "int"), ("int", "string")])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_keys_of_different_types_match_as_in_a_plain_join(spark, a, b, how):
    value = "date_add(date'2024-01-01', {})" if "date" in (a, b) else "{}"
    left = spark.range(1000).selectExpr(f"cast({value.format('cast(if(id < 600, 7, id % 9) as int)')} as {a}) as k", "id")
    right = spark.range(5, 12).selectExpr(f"cast({value.format('cast(id as int)')} as {b}) as k", "id as w")
    got = skew.skew_join(left, right, ["k"], how)
    want = left.join(right, ["k"], how).select(got.columns)
    assert got.schema["k"].dataType == want.schema["k"].dataType
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_null_keys_are_spread_and_kept(spark):
    left = spark.range(900).select(F.when(F.col("id") % 2 == 0, F.col("id") % 5).alias("k"), "id")
    right = spark.createDataFrame([(0, "a"), (3, "b"), (None, "c")], "k int, w string")
    for null_safe, with_null in ((False, 0), (True, 450)):
        got = skew.skew_join(left, right, ["k"], "left", null_safe=null_safe)
        assert got.count() == 900 and got.where("k is null and w = 'c'").count() == with_null


def test_only_keys_over_an_even_share_are_hot(spark):
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(100_000)
    assert skew.hot_keys(rows, ["id"]).count() == 0
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        small = rows.select(F.when(F.col("id") < 1900, -1).otherwise(F.col("id")).alias("k"))
        assert [tuple(r) for r in skew.hot_keys(small, ["k"]).collect()] == [(-1, 4)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)


def test_equal_rows_fill_all_slices(spark):
    same = spark.range(0, 100_000, 1, 2).select(F.lit(1).alias("k"))
    sizes = same.withColumn("s", F.pmod(skew.row_salt(same), F.lit(8))).groupBy("s").count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 13_000
    assert not skew.reads_stored_rows(same.groupBy("k").count())


def test_outer_merge_keeps_everything(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (3, "y")], "k int, r string")
    got = sorted(map(tuple, skew.outer_merge(left, right, ["k"]).collect()))
    assert got == [(1, "a", "x"), (1, "b", "x"), (2, "c", None), (3, None, "y")]


@pytest.mark.parametrize("data", [
    RNG.normal(0, 1, 4001), np.repeat([1.0, 2.0, 7.5], [3000, 500, 500]), RNG.pareto(0.3, 3000),
    np.r_[np.full(1500, 5.0), RNG.uniform(0, 1e-6, 1500)], np.array([3.0]), np.array([1.0, 2.0])],
    ids=["normal", "few", "tail", "mixed", "one", "two"])
def test_quantiles_are_exact_on_the_narrowing_path(spark, data):
    df = spark.createDataFrame(pd.DataFrame({"v": np.r_[data, np.nan]})).repartition(7)
    probs = [0, 0.01, 0.1, 0.25, 0.5, 0.501, 0.75, 0.99, 1]
    got = qn.exact_quantiles(df, ["v"], probs, max_rows=20, accuracy=50)["v"]
    np.testing.assert_allclose(got, np.quantile(data, probs), rtol=1e-12, atol=1e-15)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert qn.exact_quantiles(df, ["v"], [0.5]) == {"v": None}


def test_fill_and_trim(spark):
    df = spark.createDataFrame([(1.0, 2), (2.0, 2), (3.0, 1), (4.0, 1), (None, None)], "v double, k int")
    median, mode = im.fit_median(df, ["v"]), im.fit_mode(df, ["k"])
    assert median.values == {"v": 2.5} and mode.values == {"k": 1}
    assert [r["v"] for r in median.transform(df).where("k is null").collect()] == [2.5]
    values = [10.0] * 20 + [11.0] * 20 + [1000.0]
    out = im.fit_sd_trim(spark.createDataFrame([(v,) for v in values], "v double"), "v")
    assert out.low == round(np.mean(values) - 2 * np.std(values, ddof=1), 2)
    assert out.high == round(np.mean(values) + 2 * np.std(values, ddof=1))
    edge = im.TrimModel("v", 10.0, 11.0)
    assert edge.transform(spark.createDataFrame([(v,) for v in values], "v double")).count() == 40


def test_decile_bins_are_right_closed(spark):
    df = spark.createDataFrame([(float(v), float(v) + 1) for v in range(11)], "o double, p double")
    got = {r["bin"]: r["n"] for r in st.error_by_quantile_bin(df, "o", "p").collect()}
    assert got == {1: 2, **{b: 1 for b in range(2, 11)}}


def test_balance_table(spark):
    rows = [("a", 1.0, "x"), ("a", 2.0, "x"), ("a", 3.0, "y"), ("b", 2.0, "y"), ("b", 4.0, "y"), ("b", 6.0, "x")]
    df = spark.createDataFrame(rows, "g string, v double, c string")
    got = {(r["variable"], r["level"]): r for r in st.balance_table(df, "g", ["a", "b"], ["v"], ["c"]).collect()}
    v = got[("v", None)]
    assert (v["a_n"], v["a_mean"], v["a_sd"], v["b_mean"], v["b_sd"]) == (3, 2.0, 1.0, 4.0, 2.0)
    # P(F > 2.4) with 1 and 4 degrees of freedom
    assert v["p"] == pytest.approx(0.196263, abs=1e-5)
    assert got[("c", "x")]["a_mean"] == pytest.approx(200 / 3)
    assert got[("c", "x")]["p"] == pytest.approx(1.0)


def test_balance_table_with_an_absent_level_and_empty_column(spark):
    df = spark.createDataFrame([("a", 1.0, "x"), ("a", 3.0, "y")], "g string, v double, c string").withColumn("w", F.lit(None).cast("double"))
    got = {(r["variable"], r["level"]): r for r in st.balance_table(df, "g", ["a", "z"], ["v", "w"], ["c"]).collect()}
    assert (got["v", None]["z_n"], got["v", None]["z_mean"], got["v", None]["p"]) == (0, None, None)
    assert (got["w", None]["a_n"], got["w", None]["p"]) == (0, None)
    assert (got["c", "x"]["a_mean"], got["c", "x"]["z_n"], got["c", "x"]["z_mean"], got["c", "x"]["p"]) == (50.0, 0, None, None)


def test_equal_means_of_one_group_and_of_one_row_per_group(spark):
    one = st.group_moments(spark.createDataFrame([("a", 1.0), ("a", 2.0)], "g string, v double"), "g", ["v"])
    assert st.equal_means_test(one).head()["f"] is None and st.equal_means_p_values(one) == {"v": None}
    each = st.group_moments(spark.createDataFrame([("a", 1.0), ("b", 2.0)], "g string, v double"), "g", ["v"])
    assert st.equal_means_test(each).head()["f"] is None


def test_bins_and_quantiles_of_a_column_without_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "o double, p double")
    assert [(r["bin"], r["n"], r["mae"]) for r in st.error_by_quantile_bin(df, "o", "p").collect()] == [(None, 2, None)]
    assert st.error_by_quantile_bin(df.limit(0), "o", "p").collect() == []
    got = st.qq_table(df, "o", points=3).collect()
    assert [r["sample"] for r in got] == [None] * 3 and got[1]["theoretical"] == 0


def test_chi_square_p_values(spark):
    rows = [("a", "x")] * 20 + [("a", "y")] * 10 + [("b", "x")] * 8 + [("b", "y")] * 16 + [("b", "z")] * 5
    df = spark.createDataFrame(rows, "g string, c string")
    chi2 = st.chi_square_test(df, "c", "g").head()["chi2"]
    # with two degrees of freedom the tail is exp(-chi2 / 2)
    assert st.chi_square_p_value(df, "c", "g") == pytest.approx(np.exp(-chi2 / 2))


def test_density_of_constant_and_empty_columns(spark):
    one = spark.createDataFrame([(2.0,), (2.0,), (None,)], "v double")
    assert [r["x"] for r in st.density(one, "v").collect()] == [2.0]
    assert st.density(one.where("v > 5"), "v").collect() == []


def test_order_statistics_keep_whole_numbers_beyond_doubles(spark):
    big = 2**53
    df = spark.range(0, 5000, 1, 3).select((F.lit(big) + F.col("id")).alias("v"))
    found, n = qn.order_statistics(df, {"v": F.col("v")}, lambda _, n: [0, 1, 2, 2501, n - 1])
    assert n["v"] == 5000 and found["v"] == {r: big + r for r in (0, 1, 2, 2501, 4999)}
    found, _ = qn.order_statistics(df, {"v": F.col("v")}, lambda _, n: [1, 777, 3333], max_rows=5, accuracy=20)
    assert found["v"] == {r: big + r for r in (1, 777, 3333)}
    few = df.select((F.col("v") % 3 + big).alias("v"))
    found, _ = qn.order_statistics(few, {"v": F.col("v")}, lambda _, n: [1700, 4000], max_rows=5, accuracy=20)
    want = sorted(big + (big + i) % 3 for i in range(5000))
    assert found["v"] == {1700: want[1700], 4000: want[4000]}


def test_yates_correction(spark):
    rows = [("a", "x")] * 20 + [("a", "y")] * 10 + [("b", "x")] * 8 + [("b", "y")] * 16
    df = spark.createDataFrame(rows, "g string, c string")
    o = np.array([[20, 10], [8, 16]])
    e = np.outer(o.sum(1), o.sum(0)) / o.sum()
    assert st.chi_square_test(df, "c", "g").head()["chi2"] == pytest.approx(((abs(o - e) - 0.5) ** 2 / e).sum())


def test_density_matches_kernel_sum(spark):
    data = RNG.normal(50, 10, 800)
    got = st.density(spark.createDataFrame(pd.DataFrame({"v": data})), "v", bandwidth=3.0).toPandas().sort_values("x")
    z = (got.x.values[:, None] - data) / 3.0
    want = np.exp(-z * z / 2).sum(1) / (800 * 3.0 * math.sqrt(2 * math.pi))
    np.testing.assert_allclose(got.density, want, rtol=2e-3, atol=1e-7)
    assert len(got) == 512


def test_histogram_holds_all_rows(spark):
    df = spark.createDataFrame([(float(v),) for v in range(101)], "v double")
    got = st.histogram(df, "v", 10).toPandas()
    assert got.n.sum() == 101 and got.bin.max() == 9


def test_describe_and_profile(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, None, None), (4, 3.0, "c")], "i int, v double, s string")
    got = {r["variable"]: r for r in st.describe_all(df).collect()}
    assert (got["i"]["p50"], got["v"]["p50"], got["v"]["mean"], got["i"]["max"]) == (2.0, 2.0, 2.0, 4.0)
    prof = {r["variable"]: r for r in st.null_profile(df).collect()}
    assert (prof["s"]["nulls"], prof["s"]["type"], prof["v"]["complete"]) == (1, "string", pytest.approx(2 / 3))
    q = st.qq_table(df, "i", 3).collect()
    assert q[1]["theoretical"] == pytest.approx(0) and q[1]["sample"] == 2.0


def test_many_quantiles_are_placed_by_binary_search(spark, monkeypatch):
    """Far more ranks than a chain of cases should hold, ties and infinite values among the rows."""
    from lotline.operators import quantiles as qu

    longest, place = [0], qu._place
    monkeypatch.setattr(qu, "_place", lambda c, edges, start: longest.append(len(edges)) or place(c, edges, start))
    values = np.concatenate([np.random.default_rng(3).normal(0, 50, 6000).round(1), [np.inf, -np.inf, 0.0, -0.0]])
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(3)
    probs = [(i - 0.5) / 80 for i in range(1, 81)]
    got = qu.exact_quantiles(df, ["v"], probs, max_rows=40, accuracy=200)["v"]
    np.testing.assert_allclose(got, np.quantile(values, probs), atol=1e-9)
    assert max(longest) <= 32
