"""Geometry, spatial joins and spatial folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import cte, derive, more, table, zone_rings
from catalog.registry import query
from lotline import fixed_values as fv
from lotline.functions import geo
from lotline.operators import resample as rs
from lotline.operators import spatial as sp
from lotline.plans import location
from lotline.staging import stage


def zone_edges(spark, sf):
    return sp.edge_table(zone_rings(spark, sf))


SQL_HITS = """hits as (select p.id, e.zid from pts p join edges e
  on p.x between e.ox + 100 and e.ox + 1800 and p.y between e.oy + 100 and e.oy + 1700
  group by p.id, e.zid
  having sum(case when (e.y1 > p.y) <> (e.y2 > p.y)
      and p.x < (e.x2 - e.x1) * (p.y - e.y1) / (e.y2 - e.y1) + e.x1 then 1 else 0 end) % 2 = 1
    or max(case when (e.x2 - e.x1) * (p.y - e.y1) = (e.y2 - e.y1) * (p.x - e.x1)
      and p.x between least(e.x1, e.x2) and greatest(e.x1, e.x2)
      and p.y between least(e.y1, e.y2) and greatest(e.y1, e.y2) then 1 else 0 end) = 1)"""

# squared distance from a point p to an edge e
ALONG = ("least(greatest(((p.x-e.x1)*(e.x2-e.x1) + (p.y-e.y1)*(e.y2-e.y1)) "
         "/ ((e.x2-e.x1)*(e.x2-e.x1) + (e.y2-e.y1)*(e.y2-e.y1)), 0.0), 1.0)")
EDGE_D2 = (f"((p.x - (e.x1 + {ALONG} * (e.x2-e.x1))) * (p.x - (e.x1 + {ALONG} * (e.x2-e.x1))) "
           f"+ (p.y - (e.y1 + {ALONG} * (e.y2-e.y1))) * (p.y - (e.y1 + {ALONG} * (e.y2-e.y1))))")

D2 = "((p.x-l.x)*(p.x-l.x) + (p.y-l.y)*(p.y-l.y))"


@query("point_coordinates", cte("pts") + "select id, cast(x as double) as x, cast(y as double) as y from pts")
def _(spark, sf):
    return derive(spark, sf, "pts").select("id", F.col("x").cast("double"), F.col("y").cast("double"))


def tm_sql(p: geo.TransverseMercator) -> tuple[str, str]:
    """Easting and northing from phi and dl in radians."""
    e = repr(p._eccentricity)
    t = f"sinh(atanh(sin(phi)) - {e} * atanh({e} * sin(phi)))"
    xi, eta = f"atan2({t}, cos(dl))", f"atanh(sin(dl) / sqrt(1 + pow({t}, 2)))"
    north = " + ".join([xi, *[f"{a!r} * sin({2*j} * {xi}) * cosh({2*j} * {eta})" for j, a in enumerate(p._alpha, 1)]])
    east = " + ".join([eta, *[f"{a!r} * cos({2*j} * {xi}) * sinh({2*j} * {eta})" for j, a in enumerate(p._alpha, 1)]])
    return (f"{p.false_easting!r} + {p._radius!r} * ({east})",
            f"{p.false_northing!r} + {p._radius!r} * ({north}) - {p._origin_arc!r}")


def projected_sql(p) -> str:
    x, y = tm_sql(p)
    return cte("lonlat") + f"""select id, round({x}, 3) as x, round({y}, 3) as y from (
      select id, radians(lat) as phi, radians(lon - ({p.lon0!r})) as dl from lonlat)"""


@query("project_to_metric_plane", projected_sql(geo.MAGNA_BOGOTA))
def _(spark, sf):
    x, y = geo.MAGNA_BOGOTA.forward("lon", "lat")
    return derive(spark, sf, "lonlat").select("id", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query("project_to_city_plane", projected_sql(geo.CITY_PLANE))
def _(spark, sf):
    x, y = geo.CITY_PLANE.forward("lon", "lat")
    return derive(spark, sf, "lonlat").select("id", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query("project_to_utm_of_mean_longitude", projected_sql(geo.utm(18)))
def _(spark, sf):
    from lotline.plans.valuation import project_to_utm

    return project_to_utm(derive(spark, sf, "lonlat")).select("id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


@query("web_mercator", cte("lonlat") + """
    select id, round(6378137.0e0 * radians(lon), 3) as x, round(6378137.0e0 * asinh(tan(radians(lat))), 3) as y from lonlat""")
def _(spark, sf):
    x, y = geo.WEB_MERCATOR.forward("lon", "lat")
    return derive(spark, sf, "lonlat").select("id", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query("projection_round_trip", cte("lonlat") + "select id, round(lon, 7) as lon, round(lat, 7) as lat from lonlat")
def _(spark, sf):
    x, y = geo.MAGNA_BOGOTA.forward("lon", "lat")
    back = derive(spark, sf, "lonlat").select("id", x.alias("x"), y.alias("y"))
    lon, lat = geo.MAGNA_BOGOTA.inverse("x", "y")
    return back.select("id", F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat"))


@query("polygon_centroids", cte("zones", "edges") + """
    select zid as poly_id, round(sum((x1 + x2) * (x1*y2 - x2*y1)) / (3 * sum(x1*y2 - x2*y1)), 4) as x,
      round(sum((y1 + y2) * (x1*y2 - x2*y1)) / (3 * sum(x1*y2 - x2*y1)), 4) as y,
      round(abs(sum(x1*y2 - x2*y1)) / 2, 4) as area from edges group by 1""")
def _(spark, sf):
    out = sp.centroids(zone_edges(spark, sf))
    return out.select("poly_id", *[F.round(c, 4).alias(c) for c in ("x", "y", "area")])


def edges_cte() -> str:
    return cte("pts", "zones", "edges").replace("select zid, val,", "select zid, val, ox, oy,")


@query("point_in_polygon_join", edges_cte() + more(SQL_HITS) + """
    select p.id, p.x, p.y, h.zid as poly_id, h.zid % 7 as val from pts p left join hits h on p.id = h.id""")
def _(spark, sf):
    rings = zone_rings(spark, sf)
    attrs = rings.select("poly_id", F.col("val").cast("long"))
    return sp.point_in_polygon_join(derive(spark, sf, "pts").drop("z"), sp.edge_table(rings), attrs).select(
        "id", "x", "y", "poly_id", "val")


SQL_INSIDE = SQL_HITS.replace("hits as", "inside as").replace("    or max(case", "    and max(case").replace("then 1 else 0 end) = 1)", "then 1 else 0 end) = 0)")


@query("outside_polygons", edges_cte() + more(SQL_INSIDE) + "select id, x, y from pts where id not in (select id from inside)")
def _(spark, sf):
    return sp.outside_polygons(derive(spark, sf, "pts").drop("z"), zone_edges(spark, sf))


@query("within_disc", cte("pts", "layer") + f"""
    select id from pts p where exists (select 1 from layer l where {D2} <= 250.0 * 250.0)""")
def _(spark, sf):
    points = derive(spark, sf, "pts").select("id", "x", "y")
    return sp.with_any_within(points, derive(spark, sf, "layer"), 250).select("id")


@query("keep_city", edges_cte() + more(SQL_INSIDE) + """
    select id, x as lon, y as lat from pts where x between 500 and 9000 and y between 400.5e0 and 9500
      and id not in (select id from inside)""")
def _(spark, sf):
    ads = derive(spark, sf, "pts").selectExpr("id", "x as lon", "y as lat")
    return location.keep_city(ads, (500.0, 400.5, 9000.0, 9500.0), zone_edges(spark, sf))


PARK_TYPES = fv.EXCLUDED_PARK_TYPES + ["PARQUE"]
PARK_TYPE = "case n_nationkey % {n} {cases} end".format(
    n=len(PARK_TYPES) + 1, cases=" ".join(f"when {i} then '{t}'" for i, t in enumerate(PARK_TYPES)))


@query("park_centroids", cte("zones", "edges") + f""",
    parks as (select cast(n_nationkey as bigint) as zid, {PARK_TYPE} as kind from nation)
    select e.zid as poly_id, round(sum((x1 + x2) * (x1*y2 - x2*y1)) / (3 * sum(x1*y2 - x2*y1)), 4) as x,
      round(sum((y1 + y2) * (x1*y2 - x2*y1)) / (3 * sum(x1*y2 - x2*y1)), 4) as y
    from edges e join parks p on e.zid = p.zid
    where kind is null or kind not in ({', '.join(f"'{t}'" for t in fv.EXCLUDED_PARK_TYPES)}) group by 1""")
def _(spark, sf):
    kinds = table(spark, sf, "nation").selectExpr("cast(n_nationkey as bigint) as poly_id", f"{PARK_TYPE} as TIPOPARQUE")
    return location.park_centroids(zone_edges(spark, sf), kinds).select(
        "poly_id", *[F.round(c, 4).alias(c) for c in ("x", "y")])


@query("nearest_distance", cte("pts", "layer") + f"""
    select p.id, round(sqrt(min({D2})), 6) as distance from pts p cross join layer l group by 1""")
def _(spark, sf):
    out = sp.nearest_distance(derive(spark, sf, "pts"), derive(spark, sf, "layer"))
    return out.select("id", F.round("distance", 6).alias("distance"))


@query("nearest_centroid_distance", cte("pts", "zones", "edges") + f""", l as (
      select zid, sum((x1 + x2) * (x1*y2 - x2*y1)) / (3 * sum(x1*y2 - x2*y1)) as x,
        sum((y1 + y2) * (x1*y2 - x2*y1)) / (3 * sum(x1*y2 - x2*y1)) as y from edges where val <> 0 group by 1)
    select p.id, round(sqrt(min({D2})), 4) as distance from pts p cross join l group by 1""")
def _(spark, sf):
    rings = zone_rings(spark, sf).where("val <> 0")
    out = sp.nearest_distance(derive(spark, sf, "pts"), sp.centroids(sp.edge_table(rings)))
    return out.select("id", F.round("distance", 4).alias("distance"))


@query("distance_to_edges", cte("pts", "zones", "edges") + f"""
    select p.id, round(sqrt(min({EDGE_D2})), 6) as distance from pts p cross join edges e group by 1""")
def _(spark, sf):
    out = sp.distance_to_edges(derive(spark, sf, "pts"), zone_edges(spark, sf))
    return out.select("id", F.round("distance", 6).alias("distance"))


@query("count_within_radius", cte("pts", "layer") + f"""
    select p.id, count(l.id) as n from pts p left join layer l
      on l.x between p.x - 300 and p.x + 300 and l.y between p.y - 300 and p.y + 300 and {D2} <= 90000 group by 1""")
def _(spark, sf):
    return sp.count_within(derive(spark, sf, "pts"), derive(spark, sf, "layer"), 300, "n").select("id", "n")


HOLES = "case when (id * 7) % 10 < 3 then null else z end"


@query("fill_from_nearest_known", cte("pts") + more(f"k as (select id, x, y, {HOLES} as z from pts)") + """
    , b as (select p.id, min(struct_pack(d := (p.x-l.x)*(p.x-l.x) + (p.y-l.y)*(p.y-l.y), id := l.id, z := l.z)) as b
      from k p join k l on p.z is null and l.z is not null group by 1)
    select k.id, coalesce(k.z, b.b.z) as z from k left join b on k.id = b.id""")
def _(spark, sf):
    pts = derive(spark, sf, "pts").withColumn("z", F.expr(HOLES))
    return sp.fill_from_nearest_known(pts, "z", "id").select("id", "z")


@query("fill_from_nearest_polygon", edges_cte() + more(SQL_HITS) + f""",
    v as (select p.id, p.x, p.y, nullif(h.zid % 7, 6) as val from pts p left join hits h on p.id = h.id),
    gap as (select * from v where val is null),
    near as (select distinct e.zid from gap p cross join edges e where e.val between 1 and 5 and {EDGE_D2} <= 22500
      union select h.zid from hits h join gap g on h.id = g.id where h.zid % 7 between 1 and 5),
    d as (select p.id, e.zid, min({EDGE_D2}) as d from gap p cross join edges e where e.zid in (select zid from near) group by 1, 2),
    b as (select d.id, min(struct_pack(d := case when h.zid is null then d.d else 0.0 end, zid := d.zid)) as b
      from d left join hits h on h.id = d.id and h.zid = d.zid group by 1)
    select v.id, coalesce(v.val, b.b.zid % 7) as val from v left join b on b.id = v.id""")
def _(spark, sf):
    rings = zone_rings(spark, sf)
    attrs = rings.select("poly_id", F.expr("nullif(cast(val as bigint), 6)").alias("val"))
    edges = sp.edge_table(rings)
    joined = stage(sp.point_in_polygon_join(derive(spark, sf, "pts").drop("z"), edges, attrs).drop("poly_id"))
    return sp.fill_from_nearest_polygon(joined, edges, attrs, "val", 150).select("id", "val")


@query("semivariogram", cte("pts") + """, p as (
      select *, floor(x/300.0) as cx, floor(y/300.0) as cy from pts),
    q as (select p.id, p.x, p.y, p.z, p.cx + i as cx, p.cy + j as cy from p
      cross join (select unnest([-1, 0, 1]) as i) cross join (select unnest([-1, 0, 1]) as j)),
    d as (select sqrt((a.x-b.x)**2 + (a.y-b.y)**2) as d, (a.z-b.z)**2 as g
      from p a join q b on a.cx = b.cx and a.cy = b.cy and a.id < b.id)
    select cast(greatest(ceil(d / 20), 1) as integer) as bin, count(*) as pairs, round(avg(d), 4) as distance,
      round(avg(g) / 2 / 1e6, 4) as gamma from d where d <= 300 group by 1""")
def _(spark, sf):
    out = sp.semivariogram(derive(spark, sf, "pts"), "z", 300, 20)
    return out.select("bin", "pairs", F.round("distance", 4).alias("distance"), F.round(F.col("gamma") / 1e6, 4).alias("gamma"))


# --- folds -------------------------------------------------------------------------------------



def cuts(cells: str, mark: str, k: int = 5) -> str:
    """Common table expressions that give each block its run of the k equal runs in mark order."""
    wanted = ", ".join(f"cast(ceil(n * {j} / {k}.0) as bigint)" for j in range(1, k))
    return f"""m as (select cx, cy, {mark} as mark from (select distinct cx, cy from {cells})),
    o as (select mark, row_number() over (order by mark) as r, count(*) over () as n from m),
    t as (select mark from o where r in ({wanted})),
    f as (select cx, cy, cast((select count(*) from t where t.mark < m.mark) as integer) as fold from m)"""


DEAL = "(cx * 7919 + cy * 104729 + 15485863) % 10007"


@query("square_block_folds", cte("pts") + f""",
    e as (select min(x) as x0, min(y) as y0, (max(x) - min(x)) / 10 as w, (max(y) - min(y)) / 10 as h from pts),
    c as (select id, cast(least(floor((x - (select x0 from e)) / (select w from e)), 9) as bigint) as cx,
      cast(least(floor((y - (select y0 from e)) / (select h from e)), 9) as bigint) as cy from pts),
    {cuts('c', DEAL)}
    select id, cx, cy, cast(fold as integer) as fold from c join f using (cx, cy)""")
def _(spark, sf):
    cells = rs.square_cells(derive(spark, sf, "pts"))
    return rs.block_folds(cells, 5, F.expr(DEAL)).select("id", "cx", "cy", "fold")


HEX = """
    a as (select id, x, y, (x * 0.5773502691896257e0 - y / 3.0e0) / 692.820323027551e0 as q,
      (y * 0.6666666666666666e0) / 692.820323027551e0 as r from pts),
    b as (select *, round_even(q, 0) as rq, round_even(r, 0) as rr, round_even(-q - r, 0) as rs from a),
    c as (select *, abs(rq - q) as dq, abs(rr - r) as dr, abs(rs - (-q - r)) as ds from b),
    hex as (select id, x, y, cast(case when dq > dr and dq > ds then -rr - rs else rq end as bigint) as cx,
      cast(case when not (dq > dr and dq > ds) and dr > ds then -rq - rs else rr end as bigint) as cy from c),
    """ + cuts("hex", "(cx * 7919 + cy * 104729 + 15485863000) % 10007")
HEX_DEAL = "(cx * 7919 + cy * 104729 + 15485863000) % 10007"


@query("hexagon_block_folds", cte("pts") + "," + HEX + "select id, cx, cy, fold from hex join f using (cx, cy)")
def _(spark, sf):
    cells = rs.hexagon_cells(derive(spark, sf, "pts"), 1200)
    return rs.block_folds(cells, 5, F.expr(HEX_DEAL)).select("id", "cx", "cy", "fold")


@query("buffered_fold_roles", cte("pts") + "," + HEX + """,
    rows_ as (select id, x, y, fold, floor(x/600.0) as gx, floor(y/600.0) as gy from hex join f using (cx, cy)),
    n as (select id, x, y, fold, gx + i as gx, gy + j as gy from rows_
      cross join (select unnest([-1, 0, 1]) as i) cross join (select unnest([-1, 0, 1]) as j)),
    close as (select distinct a.id, b.fold from rows_ a join n b on a.gx = b.gx and a.gy = b.gy and a.fold <> b.fold
      and (a.x-b.x)*(a.x-b.x) + (a.y-b.y)*(a.y-b.y) <= 360000)
    select o.id, cast(k.k as integer) as fold, case when o.fold = k.k then 'test' else 'train' end as role
    from rows_ o cross join (select unnest([0, 1, 2, 3, 4]) as k) k
    left join close c on c.id = o.id and c.fold = k.k where c.id is null""")
def _(spark, sf):
    cells = rs.hexagon_cells(derive(spark, sf, "pts"), 1200)
    return rs.fold_roles(rs.block_folds(cells, 5, F.expr(HEX_DEAL)), 5, "id", buffer=600)


TRY = "cast((cx * 7919 + cy * 104729 + (cx * cy + 17) * (t * t + 31 * t + 7)) % 1009 % 5 as integer)"


@query("balanced_block_folds", cte("pts") + f""",
    c as (select id, cast(floor(x / 1000.0) as bigint) as cx, cast(floor(y / 1000.0) as bigint) as cy from pts),
    n as (select cx, cy, count(*) as n from c group by 1, 2),
    s as (select t, fold, sum(n) as n from (select n, t, {TRY} as fold from n
      cross join (select unnest(range(100)) as t)) group by 1, 2),
    best as (select t from s group by 1 order by sum(n * n), t limit 1)
    select id, {TRY.replace('t * t + 31 * t', 'best.t * best.t + 31 * best.t')} as fold from c cross join best""")
def _(spark, sf):
    pts = derive(spark, sf, "pts").selectExpr(
        "id", "cast(floor(x / 1000.0) as bigint) as cx", "cast(floor(y / 1000.0) as bigint) as cy")

    def deal(t):
        mix = t * t + 31 * t + 7
        spot = (F.col("cx") * 7919 + F.col("cy") * 104729 + (F.col("cx") * F.col("cy") + 17) * mix) % 1009
        return (spot % 5).cast("int")

    return rs.balanced_block_folds(pts, 5, 100, deal).select("id", "fold")


MARK = "((o_orderkey % 2147483647) * 48271) % 2147483647"


@query("stratified_split", f"""
    with b as (select quantile_cont(o_totalprice, 0.25) as b1, quantile_cont(o_totalprice, 0.5) as b2,
      quantile_cont(o_totalprice, 0.75) as b3 from orders),
    s as (select o_orderkey, case when o_totalprice <= (select b1 from b) then 1 when o_totalprice <= (select b2 from b) then 2
      when o_totalprice <= (select b3 from b) then 3 else 4 end as stratum, {MARK} as mark from orders)
    select o_orderkey, stratum, cast(row_number() over (partition by stratum order by mark)
      <= ceil(0.9 * count(*) over (partition by stratum)) as integer) as in_train from s""")
def _(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return rs.stratified_split(df, "o_totalprice", 0.9, F.expr(MARK)).drop("o_totalprice")


@query("random_hold_out", f"""
    select o_orderkey, cast(row_number() over (order by {MARK}) <= floor(count(*) over () / 3.0) as integer) as held_out
    from orders""")
def _(spark, sf):
    return rs.hold_out(table(spark, sf, "orders").select("o_orderkey"), 1 / 3, F.expr(MARK))


@query("last_rows_held_out", """
    select o_orderkey, cast(row_number() over (order by o_orderkey desc) <= floor(count(*) over () * 0.2) as integer) as held_out
    from orders""")
def _(spark, sf):
    return rs.last_rows_held_out(table(spark, sf, "orders").select("o_orderkey"), 0.2, "o_orderkey")


@query("random_folds", f"select o_orderkey, cast(({MARK}) % 5 as integer) as fold from orders")
def _(spark, sf):
    return rs.random_folds(table(spark, sf, "orders").select("o_orderkey"), 5, mark=F.expr(MARK))
