import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lotline.operators import features as ft
from lotline.operators import resample as rs

RNG = np.random.default_rng(3)


def points(spark, n=400):
    xy = RNG.uniform(0, 5000, (n, 2))
    return spark.createDataFrame(pd.DataFrame({"id": range(n), "x": xy[:, 0], "y": xy[:, 1]}))


def test_polynomial_is_orthonormal(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 11)], "v double")
    p = ft.fit_polynomial(df, "v").transform(df).toPandas()
    a, b = p.v_poly1.values, p.v_poly2.values
    assert abs(a.sum()) < 1e-12 and abs(b.sum()) < 1e-12 and abs(a @ b) < 1e-12
    assert a @ a == pytest.approx(1) and b @ b == pytest.approx(1) and b[0] > 0


def test_one_hot_and_scale(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 3.0), ("b", 5.0)], "k string, v double")
    out = ft.one_hot_columns(df, "k")
    assert out.columns == ["v", "k_a", "k_b", "k_NA"] and out.agg(F.sum("k_NA")).head()[0] == 1
    scaled = ft.fit_scale(df, ["v"]).transform(df)
    assert [r["v"] for r in scaled.collect()] == [-1.0, 0.0, 1.0]


def test_preparation_drops_constants_and_takes_unseen_levels(spark):
    df = spark.createDataFrame([("a", 1.0, 7.0), ("b", 2.0, 7.0), ("a", 4.0, 7.0)], "k string, v double, c double")
    model = ft.preparation(["v", "c"], ["k"]).fit(df)
    new = spark.createDataFrame([("zzz", 3.0, 7.0)], "k string, v double, c double")
    size = len(model.transform(df).head()["features"])
    assert len(model.transform(new).head()["features"]) == size
    names = ["v", "c", "k"]
    assert ft.top_features([0.2, 0.5, 0.2], names, 2) == ["c", "v"]


def test_category_codes(spark):
    df = spark.createDataFrame([("Casa",), ("Apartamento",), ("otro",)], "k string")
    out = ft.category_codes("k", ["Casa", "Apartamento"], "i").transform(df)
    assert [r["i"] for r in out.collect()] == [0.0, 1.0, 2.0]


def test_stratified_split_shares(spark):
    df = spark.range(1000).withColumn("t", (F.col("id") * 37 % 1000).cast("double"))
    out = rs.stratified_split(df, "t", 0.9, rs.random_mark(["id"], 1))
    got = out.groupBy("stratum").agg(F.count("*").alias("n"), F.sum("in_train").alias("k")).collect()
    assert len(got) == 4 and all(r["k"] == int(np.ceil(0.9 * r["n"])) for r in got)


def test_folds_do_not_depend_on_partitions(spark):
    df = points(spark)
    for make in (
        lambda d: rs.random_folds(d, 5, ["id"], 1),
        lambda d: rs.block_folds(rs.square_cells(d), 5, seed=2),
        lambda d: rs.block_folds(rs.hexagon_cells(d, 800), 5, seed=2),
        lambda d: rs.balanced_block_folds(rs.square_cells(d, 1000.0), 5, 20),
        lambda d: rs.hold_out(d, 1 / 3, rs.random_mark(["id"], 4)).withColumn("fold", F.col("held_out")),
    ):
        a, b = (sorted((r["id"], r["fold"]) for r in make(d).select("id", "fold").collect())
                for d in (df, df.repartition(64)))
        assert a == b and len(a) == 400


def test_hold_out_parts_ties_and_large_marks_exactly(spark):
    df = spark.range(1000).withColumn("mark", F.col("id") % 4)
    out = rs.hold_out(df, 0.3, F.col("mark"), tie=F.col("id"))
    held = [r["id"] for r in out.where("held_out = 1").collect()]
    assert len(held) == 300 and sorted(held) == sorted([i for i in range(1000) if i % 4 == 0] + [i for i in range(200) if i % 4 == 1])
    large = spark.range(1000).select((F.lit(2**60) + F.col("id")).alias("k"))
    assert {r["k"] - 2**60 for r in rs.last_rows_held_out(large, 0.1, "k").where("held_out = 1").collect()} == set(range(900, 1000))


def test_hold_out_is_exact(spark):
    out = rs.hold_out(spark.range(1000), 1 / 3, rs.random_mark(["id"], 4))
    assert out.agg(F.sum("held_out")).head()[0] == 333
    last = rs.last_rows_held_out(spark.range(1000), 0.2, "id")
    assert last.where("held_out = 1").agg(F.min("id"), F.count("*")).head()[:] == (800, 200)


def test_hexagons_are_nearest_centres(spark):
    size = 700.0
    got = rs.hexagon_cells(points(spark), size).toPandas()
    radius = size / np.sqrt(3)

    def centre(q, r):
        return radius * np.sqrt(3) * (q + r / 2), radius * 1.5 * r

    own = np.hypot(got.x - centre(got.cx, got.cy)[0], got.y - centre(got.cx, got.cy)[1])
    for dq, dr in [(1, 0), (0, 1), (-1, 1), (-1, 0), (0, -1), (1, -1)]:
        cx, cy = centre(got.cx + dq, got.cy + dr)
        assert (own <= np.hypot(got.x - cx, got.y - cy) + 1e-6).all()


def test_blocks_get_equal_numbers_of_cells(spark):
    out = rs.block_folds(rs.square_cells(points(spark)), 5, seed=9)
    per = out.select("cx", "cy", "fold").distinct().groupBy("fold").count().toPandas()["count"]
    assert per.max() - per.min() <= 1


def test_buffer_keeps_training_rows_away(spark):
    df = rs.block_folds(rs.hexagon_cells(points(spark, 200), 1200), 5, seed=1)
    roles = rs.fold_roles(df, 5, "id", buffer=600).toPandas()
    rows = df.toPandas().set_index("id")
    assert sorted(roles[roles.role == "test"].id) == list(range(200))
    for f in range(5):
        inside = rows[rows.fold == f]
        train = rows.loc[roles[(roles.fold == f) & (roles.role == "train")].id]
        d = np.hypot(rows.x.values[:, None] - inside.x.values, rows.y.values[:, None] - inside.y.values).min(1)
        want = {i for i, k in enumerate(rows.index) if rows.fold[k] != f and d[i] > 600}
        assert {rows.index[i] for i in want} == set(train.index)
