"""Value comparison of a Spark query with its SQL on the same tables."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal
from pathlib import Path

import duckdb

FAMILIES = {
    "int": ("tinyint", "smallint", "integer", "bigint", "int", "hugeint"),
    "float": ("double", "float"),
    "text": ("varchar", "string"),
}


def family(kind: str) -> str:
    kind = kind.lower()
    return next((f for f, names in FAMILIES.items() if kind in names), kind)


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.sql(f"create view {path.stem} as select * from '{path}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def sort_key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def compare(df, con, sql: str) -> list[str]:
    """Differences, none when both sides agree exactly."""
    names = sorted(df.columns)
    got = [tuple(plain(r[c]) for c in names) for r in df.select(*[f"`{c}`" for c in names]).collect()]
    rel = con.sql(sql)
    problems = []
    if sorted(rel.columns) != names:
        return [f"columns {names} vs {sorted(rel.columns)}"]
    kinds = dict(zip(rel.columns, map(str, rel.types)))
    for c, t in df.dtypes:
        if family(t) != family(kinds[c]):
            problems.append(f"type of {c}: {t} vs {kinds[c]}")
    order = [rel.columns.index(c) for c in names]
    want = [tuple(plain(r[i]) for i in order) for r in rel.fetchall()]
    if len(got) != len(want):
        return [*problems, f"rows {len(got)} vs {len(want)}"]
    got, want = sorted(got, key=sort_key), sorted(want, key=sort_key)
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        problems.append(f"{len(bad)} of {len(got)} rows differ ({names}), first: {bad[0]}")
    return problems
