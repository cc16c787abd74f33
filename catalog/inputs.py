"""Inputs derived from the given tables, once as DataFrames and once as SQL common table expressions.

Both forms come from the same expressions, which Spark SQL and ANSI engines compute alike. Keys are
reduced before they are squared, so the arithmetic holds for keys of any size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lattice(key: str, a: int, b: int, c: int, modulus: int) -> str:
    k = f"({key} % {modulus})"
    return f"({k}*{k}*{a} + {k}*{b} + {c}) % {modulus}"


# name -> (table, {column: expression})
DERIVED: dict[str, tuple[str, dict[str, str]]] = {
    "pts": ("orders", {
        "id": "o_orderkey",
        "x": _lattice("o_orderkey", 31, 7919, 0, 10007),
        "y": _lattice("o_orderkey", 17, 104729, 0, 10009),
        "z": "o_totalprice",
    }),
    "layer": ("supplier", {
        "id": "s_suppkey",
        "x": _lattice("s_suppkey", 57, 613, 11, 10007),
        "y": _lattice("s_suppkey", 91, 409, 7, 10009),
    }),
    "zones": ("nation", {
        "zid": "cast(n_nationkey as bigint)",
        "val": "n_nationkey % 7",
        "ox": "cast((n_nationkey % 5)*2000 as bigint)",
        "oy": "cast(floor(n_nationkey/5.0) as bigint)*2000",
    }),
    "ads": ("part", {
        "id": "p_partkey",
        "yr": "2020 + p_partkey % 3",
        "mon": "1 + p_partkey % 12",
        "title": "case p_partkey % 4 when 0 then 'Apartamento en venta' when 1 then 'Casa amplia' "
                 "when 2 then 'Venta de inmueble' end",
        "text": "'Hermoso ' || p_name || case p_partkey % 6 "
                "when 0 then ' apto de ' || cast(p_size + 30 as string) || ' m2 con tres banos' "
                "when 1 then ' con terraza de ' || cast(p_size as string) || ' mts y 2 banos' "
                "when 2 then ' lote 8 x ' || cast(p_size as string) || ' vigilancia 24x7' "
                "when 3 then ' area construida ' || cast(p_size + 60 as string) || ' m2, parquadero y gimnasio' "
                "when 4 then '  dos  banos, picina' else ' balcom y seguridad' end",
        "stored": "case when p_partkey % 2 = 0 then 'Casa' else 'Apartamento' end",
        "surface_total": "case when p_partkey % 3 = 0 then cast(null as double) "
                         "else cast(p_size*4 + 20 as double) end",
        "bathrooms": "case when p_partkey % 5 = 0 then cast(null as double) "
                     "else cast(1 + p_partkey % 4 as double) end",
        "rooms": "1 + p_size % 5",
        "price": "p_retailprice * 300000",
    }),
    "ads_history": ("lineitem", {
        "k1": "l_partkey", "k2": "l_suppkey", "yr": "year(l_shipdate)", "mon": "month(l_shipdate)",
        "ord": "l_orderkey", "line": "l_linenumber", "qty": "l_quantity", "price": "l_extendedprice",
    }),
    "lonlat": ("orders", {
        "id": "o_orderkey",
        "lon": "-74.13 + (" + _lattice("o_orderkey", 31, 7919, 0, 10007) + ") / 100000.0e0",
        "lat": "4.6e0 + (" + _lattice("o_orderkey", 17, 104729, 0, 10009) + ") / 100000.0e0",
    }),
    # predictions made from the observed value, so that errors have a shape
    "scored": ("lineitem", {
        "id": "l_orderkey", "line": "l_linenumber",
        "obs": "l_extendedprice",
        "pred": "l_extendedprice * (0.8e0 + l_discount * 4) + l_quantity * 10",
        "fold": "cast(l_orderkey % 5 as int)",
        "kind": "l_returnflag",
    }),
    # target with known coefficients
    "homes": ("lineitem", {
        "id": "l_orderkey", "line": "l_linenumber", "supp": "l_suppkey",
        "qty": "l_quantity", "disc": "l_discount", "tax": "l_tax",
        "kind": "l_returnflag", "state": "l_linestatus",
        "x": _lattice("l_orderkey", 31, 7919, 0, 10007),
        "y": _lattice("l_orderkey", 17, 104729, 0, 10009),
        "target": "3*l_quantity - 40*l_discount + 25*l_tax "
                  "+ ((l_orderkey % 10007) * 7919 + l_linenumber * 104729) % 101 / 25.0e0",
    }),
}

ZONE_CORNERS = [(100, 100), (1700, 300), (1800, 1700), (300, 1600)]


def derive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, columns = DERIVED[name]
    return table(spark, sf_dir, source).selectExpr(*[f"{e} as {c}" for c, e in columns.items()])


def cte(*names: str) -> str:
    """`with name as (...)` for each derived input, ready to be followed by a select."""
    parts = []
    for name in names:
        if name == "edges":
            parts.append(_edges_sql())
            continue
        source, columns = DERIVED[name]
        lines = ", ".join(f"{e} as {c}" for c, e in columns.items())
        parts.append(f"{name} as (select {lines} from {source})")
    return "with " + ",\n".join(parts) + "\n"


def more(*ctes: str) -> str:
    """Further common table expressions after `cte`."""
    return "".join(f", {c}\n" for c in ctes)


def zone_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones as stored polygons: (poly_id, val, rings)."""
    points = ", ".join(
        f"struct(cast(ox + {dx} as double) as x, cast(oy + {dy} as double) as y)" for dx, dy in ZONE_CORNERS
    )
    return derive(spark, sf_dir, "zones").selectExpr(
        "zid as poly_id", "val", f"array(array({points})) as rings"
    )


def _edges_sql() -> str:
    rows = []
    corners = ZONE_CORNERS + ZONE_CORNERS[:1]
    for (ax, ay), (bx, by_) in zip(corners, corners[1:]):
        rows.append(
            f"select zid, val, cast(ox+{ax} as double) as x1, cast(oy+{ay} as double) as y1, "
            f"cast(ox+{bx} as double) as x2, cast(oy+{by_} as double) as y2 from zones"
        )
    return "edges as (" + " union all ".join(rows) + ")"
