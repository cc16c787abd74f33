"""Joins of listings with point and polygon layers.

Listings carry plain coordinate columns in metres. Every operator works on distinct places first
and brings the answer back by the coordinates, so many listings at one place cost as much as one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline.functions.geo import crosses_ray, on_segment, segment_squared_distance, squared_distance
from lotline.operators import grid
from lotline.operators.pairs import binned_pairs
from lotline.operators.skew import SLICES, hot_from_counts, skew_join
from lotline.staging import stage, stage_observed


def places(points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Distinct places as boxes of no extent, weighted by the number of rows there."""
    known = points.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    at = [F.col(x).cast("double").alias("x1"), F.col(y).cast("double").alias("y1")]
    counted = known.groupBy(*at).agg(F.count(F.lit(1)).alias("w"))
    return counted.select("x1", "y1", F.col("x1").alias("x2"), F.col("y1").alias("y2"), "w")


def _attach(
    points: DataFrame, found: DataFrame, at: grid.Side, x: str, y: str, how: str = "left"
) -> DataFrame:
    """Bring columns found per place (px, py) back to the rows; crowded places are spread out."""
    keyed = points.withColumns({"px": F.col(x).cast("double"), "py": F.col(y).cast("double")})
    return skew_join(keyed, found, ["px", "py"], how, hot=at.hot.toDF("px", "py", SLICES)).drop("px", "py")


def _point_d2() -> Column:
    return squared_distance("x1", "y1", "b_x1", "b_y1")


def nearest_by_place(at: grid.Side, layer: DataFrame, name: str, x: str = "x", y: str = "y") -> DataFrame:
    """(px, py, name): distance from each place to the nearest point of the layer."""
    best = grid.nearest(at, grid.make_side(places(layer, x, y), "layer"), _point_d2(), [], ["x1", "y1"])
    return best.select(F.col("x1").alias("px"), F.col("y1").alias("py"), F.sqrt("best.d2").alias(name))


def count_by_place(
    at: grid.Side, layer: DataFrame, radius: float, name: str, x: str = "x", y: str = "y"
) -> DataFrame:
    """(px, py, name): number of layer points within the radius of each place, where there are any."""
    to = grid.make_side(places(layer, x, y), "layer")
    near = grid.weight_within(at, to, radius, _point_d2(), columns=["x1", "y1"])
    return near.select(F.col("x1").alias("px"), F.col("y1").alias("py"), F.col("w").alias(name))


def nearest_distance(
    points: DataFrame, layer: DataFrame, name: str = "distance", x: str = "x", y: str = "y"
) -> DataFrame:
    """Add the distance to the nearest point of the layer."""
    return with_point_layers(points, {name: layer}, {}, x, y)


def count_within(
    points: DataFrame, layer: DataFrame, radius: float, name: str = "count", x: str = "x", y: str = "y"
) -> DataFrame:
    """Add the number of layer points within the radius, rim included; 0 where there are none."""
    return with_point_layers(points, {}, {name: (layer, radius)}, x, y)


def with_any_within(
    points: DataFrame, layer: DataFrame, radius: float, x: str = "x", y: str = "y"
) -> DataFrame:
    """Rows with at least one layer point within the radius, rim included."""
    at = grid.make_side(places(points, x, y))
    to = grid.make_side(places(layer, x, y), "layer")
    found = grid.any_within(at, to, radius, _point_d2(), columns=["x1", "y1"])
    near = found.select(F.col("x1").alias("px"), F.col("y1").alias("py")).distinct()
    return _attach(points, near, at, x, y, "left_semi")


def with_point_layers(
    points: DataFrame, nearest: Mapping[str, DataFrame], within: Mapping[str, tuple[DataFrame, float]],
    x: str = "x", y: str = "y",
) -> DataFrame:
    """Add nearest distances and counts for several layers at once.

    Places are made once, the answers are put together per place, and the rows are joined once.
    """
    at = grid.make_side(places(points, x, y))
    answers = [nearest_by_place(at, layer, name, x, y) for name, layer in nearest.items()]
    answers += [count_by_place(at, layer, r, name, x, y) for name, (layer, r) in within.items()]
    found = answers[0]
    if len(answers) > 1:
        found = at.df.select(F.col("x1").alias("px"), F.col("y1").alias("py"))
        for answer in answers:
            found = found.join(answer, ["px", "py"], "left")
    known = F.col(x).isNotNull() & F.col(y).isNotNull()
    zero = F.lit(0).cast("long")
    counts = {name: F.when(known, F.coalesce(F.col(name), zero)) for name in within}
    out = _attach(points, found, at, x, y)
    return out.withColumns(counts) if counts else out


def fill_from_nearest_known(
    points: DataFrame, column: str, key: str, x: str = "x", y: str = "y"
) -> DataFrame:
    """Rows without a value take that of the nearest row that has one; ties to the lowest key."""
    known = points.where(F.col(column).isNotNull() & F.col(x).isNotNull() & F.col(y).isNotNull())
    at = [F.col(x).cast("double").alias("x1"), F.col(y).cast("double").alias("y1")]
    # one source per place: the one with the lowest key
    sources = known.groupBy(*at).agg(F.min(F.struct(key, column)).alias("s")).select(
        "x1", "y1", F.col("x1").alias("x2"), F.col("y1").alias("y2"), F.lit(1).alias("w"),
        F.col(f"s.{key}").alias(key), F.col(f"s.{column}").alias(column),
    )
    lacking = points.where(F.col(column).isNull())
    at = grid.make_side(places(lacking, x, y))
    best = grid.nearest(at, grid.make_side(sources, "sources"), _point_d2(), [key, column], ["x1", "y1"])
    found = best.select(
        F.col("x1").alias("px"), F.col("y1").alias("py"), F.col(f"best.{column}").alias("_fill")
    )
    filled = _attach(lacking, found, at, x, y).withColumn(column, F.col("_fill")).drop("_fill")
    return points.where(F.col(column).isNotNull()).unionByName(filled.select(*points.columns))


# --- polygons --------------------------------------------------------------------------------


def edge_table(polygons: DataFrame, key: str = "poly_id", rings: str = "rings") -> DataFrame:
    """One row per edge (key, ring, x1, y1, x2, y2) from rings of points; open rings are closed."""
    ring = polygons.select(F.col(key), F.posexplode(rings).alias("ring", "pts"))
    nxt = F.get("pts", (F.col("pos") + 1) % F.size("pts"))
    edges = ring.select(key, "ring", "pts", F.posexplode("pts").alias("pos", "p")).withColumn("q", nxt)
    out = edges.select(
        key, "ring", *[F.col(f"{e}.{c}").cast("double").alias(f"{c}{k}") for k, e in ((1, "p"), (2, "q"))
                       for c in ("x", "y")]
    )
    return out.where("x1 <> x2 or y1 <> y2")


def centroids(edges: DataFrame, key: str = "poly_id") -> DataFrame:
    """Area centroid per polygon; outer rings and holes run in opposite directions.

    Coordinates are taken relative to a corner of the polygon, for the sake of small differences.
    """
    corner = edges.groupBy(key).agg(F.min("x1").alias("ox"), F.min("y1").alias("oy"))
    e = skew_join(edges, corner, [key], "inner")
    ax, ay = F.col("x1") - F.col("ox"), F.col("y1") - F.col("oy")
    bx, by = F.col("x2") - F.col("ox"), F.col("y2") - F.col("oy")
    cross = ax * by - bx * ay
    sums = e.groupBy(key).agg(
        F.sum(cross).alias("a2"), F.sum((ax + bx) * cross).alias("sx"), F.sum((ay + by) * cross).alias("sy"),
        F.first("ox").alias("ox"), F.first("oy").alias("oy"),
    )
    return sums.select(
        key, (F.col("ox") + F.try_divide("sx", F.col("a2") * 3)).alias("x"),
        (F.col("oy") + F.try_divide("sy", F.col("a2") * 3)).alias("y"), (F.abs("a2") / 2).alias("area"),
    )


def _slabs(edges: DataFrame, key: str) -> DataFrame:
    """Bounding box of each polygon and the number of horizontal slabs to cut it into.

    As many slabs as keep the number of edge pieces within a small multiple of the edges.
    """
    box = edges.groupBy(key).agg(
        F.min(F.least("x1", "x2")).alias("bx1"), F.max(F.greatest("x1", "x2")).alias("bx2"),
        F.min(F.least("y1", "y2")).alias("by1"), F.max(F.greatest("y1", "y2")).alias("by2"),
        F.count(F.lit(1)).alias("n"), F.sum(F.abs(F.col("y2") - F.col("y1"))).alias("rise"),
    )
    height = F.col("by2") - F.col("by1")
    slabs = F.floor(F.coalesce(F.try_divide(2 * F.col("n") * height, F.col("rise")), F.lit(1)))
    level = F.greatest(F.lit(-30), F.ceil(F.log2(F.greatest(F.col("bx2") - F.col("bx1"), height, F.lit(1e-9)))))
    return box.withColumns({
        "slabs": F.greatest(slabs, F.lit(1)), "height": height, "level": level.cast("int"),
    })


def _slab(y: Column | str) -> Column:
    y = F.col(y) if isinstance(y, str) else y
    spot = F.try_divide((y - F.col("by1")) * F.col("slabs"), "height")
    return F.least(F.greatest(F.floor(F.coalesce(spot, F.lit(0.0))), F.lit(0)), F.col("slabs") - 1)


def containment(at: grid.Side, edges: DataFrame, key: str = "poly_id", rim: bool = True) -> DataFrame:
    """(px, py, key) for every place (x1, y1) inside a polygon, or on its rim if that counts.

    Boxes of polygons go into a grid whose cell size fits the box, so that each covers at most
    four cells of its own level; a place looks into one cell per level in use. In each
    candidate polygon a place then meets only the edges of its own horizontal slab.
    """
    slabs, seen = stage_observed(_slabs(edges, key), "polygons", {
        "levels": F.collect_set("level"),
    })
    levels = seen["levels"]
    if not levels:
        none = edges.select(key, F.lit(0.0).alias("px"), F.lit(0.0).alias("py"))
        return none.select("px", "py", key).limit(0)

    def number(c, level):
        return F.floor(F.col(c) / F.pow(F.lit(2.0), level)).cast("long")

    covered = slabs.withColumns({
        "cx": F.explode(F.sequence(number("bx1", F.col("level")), number("bx2", F.col("level")))),
    }).withColumn("cy", F.explode(F.sequence(number("by1", F.col("level")), number("by2", F.col("level")))))
    looks = at.df.select(
        F.col("x1").alias("px"), F.col("y1").alias("py"),
        F.explode(F.array(*[F.lit(v) for v in sorted(levels)])).alias("level"),
    ).withColumns({"cx": number("px", F.col("level")), "cy": number("py", F.col("level"))})
    inside_box = F.col("px").between(F.col("bx1"), F.col("bx2")) & F.col("py").between(F.col("by1"), F.col("by2"))
    candidates = (
        skew_join(looks, covered, ["level", "cx", "cy"], "inner")
        .where(inside_box)
        .select("px", "py", key, _slab("py").alias("slab"))
    )
    candidates = stage(candidates, "candidates")
    size = slabs.select(key, "by1", "height", "slabs")
    big = hot_from_counts(slabs, [key], "n")
    low, high = _slab(F.least("y1", "y2")), _slab(F.greatest("y1", "y2"))
    pieces = (
        skew_join(edges, size, [key], "inner", hot=big)
        .select(key, "x1", "y1", "x2", "y2", F.explode(F.sequence(low, high)).alias("slab"))
    )
    ends = ("px", "py", "x1", "y1", "x2", "y2")
    crossed = F.count_if(crosses_ray(*ends)) % 2 == 1
    touched = F.max(on_segment(*ends))
    return (
        skew_join(candidates, pieces, [key, "slab"], "inner", spread=True)
        .groupBy("px", "py", key)
        .agg(((crossed | touched) if rim else (crossed & ~touched)).alias("hit"))
        .where("hit")
        .drop("hit")
    )


def point_in_polygon_join(
    points: DataFrame, edges: DataFrame, attributes: DataFrame | None = None, key: str = "poly_id",
    x: str = "x", y: str = "y", one_row: bool = False,
) -> DataFrame:
    """Left join of rows with the polygons they lie in: one row per hit, null where there is none.

    `attributes` (key, ...) is joined to the hits. With `one_row`, overlapping polygons give the
    lowest key only.
    """
    at = grid.make_side(places(points, x, y))
    hits = containment(at, edges, key)
    if one_row:
        hits = hits.groupBy("px", "py").agg(F.min(key).alias(key))
    if attributes is not None:
        hits = skew_join(hits, attributes, [key], "left")
    return _attach(points, hits, at, x, y)


def outside_polygons(
    points: DataFrame, edges: DataFrame, key: str = "poly_id", x: str = "x", y: str = "y"
) -> DataFrame:
    """Rows that lie in none of the polygons; the rim of a polygon is not inside."""
    at = grid.make_side(places(points, x, y))
    hits = containment(at, edges, key, rim=False)
    return _attach(points, hits.select("px", "py").distinct(), at, x, y, "left_anti")


def _edge_d2() -> Column:
    return segment_squared_distance("x1", "y1", "b_ex1", "b_ey1", "b_ex2", "b_ey2")


def _edge_boxes(edges: DataFrame, keep: Sequence[str]) -> DataFrame:
    ends = [F.col(c).alias(f"e{c}") for c in ("x1", "y1", "x2", "y2")]
    return edges.select(
        F.least("x1", "x2").alias("x1"), F.least("y1", "y2").alias("y1"),
        F.greatest("x1", "x2").alias("x2"), F.greatest("y1", "y2").alias("y2"),
        F.lit(1).alias("w"), *ends, *keep,
    )


def distance_to_edges(
    points: DataFrame, edges: DataFrame, name: str = "distance", x: str = "x", y: str = "y"
) -> DataFrame:
    """Add the distance to the nearest edge of any polygon."""
    at = grid.make_side(places(points, x, y))
    sides = grid.make_side(_edge_boxes(edges, []), "edges")
    best = grid.nearest(at, sides, _edge_d2(), [], ["ex1", "ey1", "ex2", "ey2"])
    found = best.select(F.col("x1").alias("px"), F.col("y1").alias("py"), F.sqrt("best.d2").alias(name))
    return _attach(points, found, at, x, y)


def polygons_near(
    at: grid.Side, edges: DataFrame, radius: float, key: str = "poly_id", inside: DataFrame | None = None
) -> DataFrame:
    """Keys of polygons that touch the disc around at least one place."""
    distance2 = segment_squared_distance("b_x1", "b_y1", "ex1", "ey1", "ex2", "ey2")
    near = grid.any_within(
        grid.make_side(_edge_boxes(edges, [key]), "edges"), at, radius, distance2, keys=[key], columns=["x1", "y1"]
    ).select(key)
    inside = containment(at, edges, key) if inside is None else inside
    return near.unionByName(inside.select(key)).distinct()


def fill_from_nearest_polygon(
    points: DataFrame, edges: DataFrame, attributes: DataFrame, column: str, radius: float,
    at_least: float = 1, key: str = "poly_id", x: str = "x", y: str = "y",
) -> DataFrame:
    """Rows without a value take that of the nearest candidate polygon; ties to the lowest key.

    Candidates have a value of at least `at_least` and touch the disc around some row that lacks
    a value, not necessarily the row in question.
    """
    lacking = points.where(F.col(column).isNull())
    at = grid.make_side(places(lacking, x, y))
    usable = attributes.where(F.col(column) >= at_least).select(key, column)
    edges = stage(skew_join(edges, usable, [key], "inner"), "edges")
    inside = stage(containment(at, edges, key), "inside")
    near = polygons_near(at, edges, radius, key, inside)
    candidates = skew_join(edges, near, [key], "left_semi")
    by_edge = grid.nearest(at, grid.make_side(_edge_boxes(candidates, [key, column]), "edges"), _edge_d2(),
                           [key, column], ["ex1", "ey1", "ex2", "ey2"])
    best = by_edge.select(F.col("x1").alias("px"), F.col("y1").alias("py"), "best")
    zero = skew_join(inside, usable, [key], "inner").select(
        "px", "py", F.struct(F.lit(0.0).alias("d2"), F.col(key), F.col(column)).alias("best")
    )
    found = best.unionByName(zero).groupBy("px", "py").agg(F.min("best").alias("best"))
    found = found.select("px", "py", F.col(f"best.{column}").alias("_fill"))
    filled = _attach(lacking, found, at, x, y).withColumn(column, F.col("_fill")).drop("_fill")
    return points.where(F.col(column).isNotNull()).unionByName(filled.select(*points.columns))


# --- spatial dependence ----------------------------------------------------------------------


def semivariogram(
    points: DataFrame, value: str, cutoff: float, width: float, x: str = "x", y: str = "y"
) -> DataFrame:
    """Pairs up to the cutoff by distance bin: count, mean distance, half the mean squared difference.

    Rows at one place are summed up first: their pairs with another place follow from the sums.
    Pairs are made block against block of neighbouring cells and go straight into the per-bin sums
    of the task that made them.
    """
    z = F.col(value).cast("double")
    at = [F.col(x).cast("double").alias("x1"), F.col(y).cast("double").alias("y1")]
    known = points.where(F.col(x).isNotNull() & F.col(y).isNotNull() & z.isNotNull())
    # squares of differences from the mean stay small
    mean = known.agg(F.avg(z)).head()[0] or 0.0
    z = z - F.lit(mean)
    spots = stage(known.groupBy(*at).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(z).alias("s"), F.sum(z * z).alias("q")
    ), "places")
    apart = binned_pairs(spots, cutoff, width)
    same = spots.where("n > 1").select(
        F.lit(1).alias("bin"), (F.col("n") * (F.col("n") - 1) / 2).alias("np"), F.lit(0.0).alias("dnp"),
        (F.col("n") * F.col("q") - F.col("s") * F.col("s")).alias("sq"),
    )
    return (
        apart.unionByName(same).groupBy("bin")
        .agg(F.sum("np").cast("long").alias("pairs"),
             (F.sum("dnp") / F.sum("np")).alias("distance"),
             (F.sum("sq") / F.sum("np") / 2).alias("gamma"))
    )
