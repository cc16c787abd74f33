import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lotline.operators import grid
from lotline.operators import pairs as pb
from lotline.operators import spatial as sp

RNG = np.random.default_rng(5)


def cloud(n, kind):
    """Even scatter, a far tight cluster with a third of the rows, and copies of one place."""
    even = RNG.uniform(0, 1000, (n, 2))
    if kind == "cluster":
        even[: n // 3] = [90_000, 40_000] + RNG.uniform(0, 2, (n // 3, 2))
    if kind == "copies":
        even[: n // 3] = [500.5, 500.5]
    return pd.DataFrame({"id": range(n), "x": even[:, 0], "y": even[:, 1]})


def distances(a, b):
    return np.hypot(a.x.values[:, None] - b.x.values, a.y.values[:, None] - b.y.values)


@pytest.mark.parametrize("kind,layer_kind", [("even", "cluster"), ("cluster", "even"), ("copies", "cluster")])
def test_nearest_and_count_match_brute_force(spark, kind, layer_kind, monkeypatch):
    monkeypatch.setattr(grid, "PAIRS_PER_ROW", 2)
    a, b = cloud(400, kind), cloud(300, layer_kind)
    d = distances(a, b)
    sa, sb = spark.createDataFrame(a), spark.createDataFrame(b)
    got = sp.nearest_distance(sa, sb).toPandas().sort_values("id")
    np.testing.assert_allclose(got["distance"], d.min(axis=1), rtol=0, atol=1e-9)
    got = sp.count_within(sa, sb, 150).toPandas().sort_values("id")
    assert list(got["count"]) == list((d <= 150).sum(axis=1))


def test_any_within_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(grid, "PAIRS_PER_ROW", 4)
    a, b = cloud(300, "cluster"), cloud(200, "copies")
    sides = [grid.make_side(sp.places(spark.createDataFrame(t))) for t in (a, b)]
    got = grid.any_within(*sides, 40, sp._point_d2(), columns=["x1", "y1"]).select("x1", "y1").distinct().count()
    assert got == a[distances(a, b).min(axis=1) <= 40][["x", "y"]].drop_duplicates().shape[0]


def test_count_takes_the_rim_and_zero(spark):
    a = spark.createDataFrame([(1, 0.0, 0.0), (2, 5000.0, 0.0), (3, None, 1.0)], "id int, x double, y double")
    b = spark.createDataFrame([(300.0, 0.0), (0.0, 300.1)], "x double, y double")
    got = {r["id"]: r["count"] for r in sp.count_within(a, b, 300).collect()}
    assert got == {1: 1, 2: 0, 3: None}


def test_nearest_with_an_empty_layer_is_null(spark):
    a = spark.createDataFrame([(1, 0.0, 0.0)], "id int, x double, y double")
    assert sp.nearest_distance(a, a.limit(0)).head()["distance"] is None


def test_fill_from_nearest_known(spark):
    rows = cloud(300, "copies")
    rows["v"] = np.where(rows.id % 3 == 0, np.nan, rows.id * 10.0)
    df = spark.createDataFrame(rows).withColumn("v", F.expr("nullif(v, double('NaN'))"))
    got = sp.fill_from_nearest_known(df, "v", "id").toPandas().set_index("id")["v"]
    known = rows[rows.v.notna()]
    d = distances(rows, known)
    for k, row in enumerate(rows.itertuples()):
        if np.isnan(row.v):
            best = known[np.isclose(d[k], d[k].min(), atol=1e-12)].sort_values("id").v.iloc[0]
            assert got[row.id] == best
        else:
            assert got[row.id] == row.v


SQUARE = [(0, 0), (10, 0), (10, 10), (0, 10)]
HOLE = [(6, 2), (6, 4), (8, 4), (8, 2)]


def polygons(spark):
    def ring(points):
        return [(float(x), float(y)) for x, y in points]

    rows = [
        (1, [ring(SQUARE), ring(HOLE)]),
        (2, [ring([(5, 5), (15, 5), (15, 15), (5, 15)])]),
        (3, [ring([(1000, 1000), (1900, 1000), (1900, 1900), (1000, 1900)])]),
    ]
    return spark.createDataFrame(rows, "poly_id long, rings array<array<struct<x:double,y:double>>>")


def test_containment_cases(spark):
    points = spark.createDataFrame(
        [("hole", 7.0, 3.0), ("edge", 10.0, 3.0), ("corner", 0.0, 0.0), ("both", 7.0, 7.0),
         ("out", -1.0, 5.0), ("big", 1500.0, 1200.0)], "id string, x double, y double")
    got = sp.point_in_polygon_join(points, sp.edge_table(polygons(spark)))
    hits = sorted((r["id"], r["poly_id"]) for r in got.where("poly_id is not null").collect())
    assert hits == [("big", 3), ("both", 1), ("both", 2), ("corner", 1), ("edge", 1)]
    assert {r["id"] for r in got.where("poly_id is null").collect()} == {"hole", "out"}
    one = sp.point_in_polygon_join(points, sp.edge_table(polygons(spark)), one_row=True)
    assert one.count() == 6
    out = sp.outside_polygons(points, sp.edge_table(polygons(spark)))
    assert {r["id"] for r in out.collect()} == {"hole", "out", "edge", "corner"}


def test_containment_matches_brute_force(spark):
    n = 60
    angle = np.sort(RNG.uniform(0, 2 * np.pi, n))
    radius = RNG.uniform(20, 100, n)
    star = [(float(x), float(y)) for x, y in zip(radius * np.cos(angle), radius * np.sin(angle))]
    poly = spark.createDataFrame([(1, [star])], "poly_id long, rings array<array<struct<x:double,y:double>>>")
    pts = pd.DataFrame(RNG.uniform(-110, 110, (500, 2)), columns=["x", "y"])
    pts["id"] = range(500)
    got = sp.point_in_polygon_join(spark.createDataFrame(pts), sp.edge_table(poly)).toPandas().set_index("id")
    for p in pts.itertuples():
        odd = False
        for (x1, y1), (x2, y2) in zip(star, star[1:] + star[:1]):
            if (y1 > p.y) != (y2 > p.y) and p.x < (x2 - x1) * (p.y - y1) / (y2 - y1) + x1:
                odd = not odd
        assert (got.poly_id[p.id] == 1) == odd


def test_centroid_moves_away_from_the_hole(spark):
    got = {r["poly_id"]: r for r in sp.centroids(sp.edge_table(polygons(spark))).collect()}
    assert (got[2]["x"], got[2]["y"], got[2]["area"]) == (10.0, 10.0, 100.0)
    assert got[1]["area"] == 96.0
    assert got[1]["x"] == pytest.approx((500 - 4 * 7) / 96) and got[1]["x"] < 5
    assert got[1]["y"] == pytest.approx((500 - 4 * 3) / 96) and got[1]["y"] > 5


def test_fill_from_nearest_polygon_uses_candidates_of_other_rows(spark):
    # row 2 is far from polygon 3, but row 1 makes it a candidate
    points = spark.createDataFrame(
        [(1, 1950.0, 1500.0, None), (2, 9000.0, 1500.0, None), (3, 7.0, 7.0, None), (4, 1.0, 1.0, 5)],
        "id int, x double, y double, v int")
    attrs = spark.createDataFrame([(1, 0), (2, None), (3, 4)], "poly_id long, v int")
    got = sp.fill_from_nearest_polygon(points, sp.edge_table(polygons(spark)), attrs, "v", 100)
    assert {r["id"]: r["v"] for r in got.collect()} == {1: 4, 2: 4, 3: 4, 4: 5}


def test_semivariogram_matches_brute_force(spark):
    rows = cloud(250, "copies")
    rows["z"] = RNG.normal(100, 5, 250)
    got = sp.semivariogram(spark.createDataFrame(rows), "z", 300, 50).toPandas().set_index("bin")
    d = distances(rows, rows)
    g = (rows.z.values[:, None] - rows.z.values) ** 2
    i, j = np.triu_indices(250, 1)
    d, g = d[i, j], g[i, j]
    b = np.maximum(np.ceil(d / 50), 1)
    for k in range(1, 7):
        hit = (b == k) & (d <= 300)
        assert got.pairs[k] == hit.sum()
        assert got.distance[k] == pytest.approx(d[hit].mean())
        assert got.gamma[k] == pytest.approx(g[hit].mean() / 2)


def test_pairs_of_cells_are_sorted_in_tasks_of_bounded_size(spark, monkeypatch):
    """Few cells make many pairs: tasks go by the pairs, not by the bytes of the cells."""
    monkeypatch.setattr(grid, "PAIRS_PER_ROW", 2)
    monkeypatch.setattr(grid, "CELL_PAIRS_PER_TASK", 200)
    staged, most = grid.stage_observed, []

    def seen(df, name, metrics):
        if name == "cells":
            most.append(df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).head()[0])
        return staged(df, name, metrics)

    monkeypatch.setattr(grid, "stage_observed", seen)
    a, b = cloud(400, "even"), cloud(300, "even")
    got = sp.nearest_distance(spark.createDataFrame(a), spark.createDataFrame(b)).toPandas().sort_values("id")
    np.testing.assert_allclose(got["distance"], distances(a, b).min(axis=1), rtol=0, atol=1e-9)
    assert len(most) > 1 and max(most[1:]) <= 200


@pytest.mark.parametrize("small,rows", [(0, 7), (4096, 1024), (30, 16)])
def test_semivariogram_makes_no_row_for_a_pair(spark, monkeypatch, small, rows):
    """Blocks of any size, met one by one or together; the join has blocks in it and not pairs of places."""
    monkeypatch.setattr(pb, "SMALL", max(small, 1))
    monkeypatch.setattr(pb, "BLOCK_ROWS", rows)
    monkeypatch.setattr(pb, "CHUNK_ROWS", 3)
    frame = cloud(300, "copies").round(0).assign(z=lambda t: t.id * 1.0)
    df = spark.createDataFrame(frame)
    got = sp.semivariogram(df, "z", 130, 50).toPandas().set_index("bin")
    i, j = np.triu_indices(300, 1)
    d, g = distances(frame, frame)[i, j], ((frame.z.values[:, None] - frame.z.values) ** 2)[i, j]
    b = np.maximum(np.ceil(d / 50), 1)
    assert sorted(got.index) == [1, 2, 3]
    for k in (1, 2, 3):
        hit = (b == k) & (d <= 130)
        assert got.pairs[k] == hit.sum()
        assert got.distance[k] == pytest.approx(d[hit].mean()) and got.gamma[k] == pytest.approx(g[hit].mean() / 2)
    places = spark.createDataFrame(frame.drop_duplicates(["x", "y"])).select(F.col("x").alias("x1"), F.col("y").alias("y1"), *[F.lit(1.0).alias(c) for c in "nsq"])
    blocks = pb.place_blocks(places, 130).select(F.size("x1").alias("n")).toPandas().n
    assert blocks.max() <= rows and blocks.sum() == places.count()
