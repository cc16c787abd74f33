"""Exact order statistics and quantiles of whole tables.

Spark's own exact `percentile` keeps every distinct value of a column in one buffer. Here each
wanted rank is closed in from both sides instead: a mergeable quantile sketch proposes a bracket,
one counting pass proves it, and the sketch is run again inside the bracket until so few rows are
left that they fit in one short array. Each pass is one scan with map-side aggregation and a
result of fixed size.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SKETCH_ACCURACY = 10_000
MAX_BRACKET_ROWS = 100_000
MAX_CASES = 32  # beyond so many ends, values are placed by binary search


@dataclass
class _Search:
    """Search state for one rank of one column: the rank lies strictly inside (low, high)."""

    name: str
    rank: int
    low: float
    high: float
    inside: int
    below: int = 0
    value: float | None = None
    stuck: bool = False

    @property
    def zone(self):
        return self.name, self.low, self.high


def order_statistics(
    df: DataFrame,
    columns: Mapping[str, Column],
    ranks: Callable[[str, int], Sequence[int]],
    max_rows: int = MAX_BRACKET_ROWS,
    accuracy: int = SKETCH_ACCURACY,
) -> tuple[dict[str, dict[int, float]], dict[str, int]]:
    """Values at zero-based ranks of each column (nulls and NaN left out), and the row counts.

    Whole numbers and decimals keep their type, so values that doubles cannot tell apart are told apart here.
    `ranks` gets a column name and its number of values and returns the wanted ranks.
    """
    names = list(columns)
    data = df.select(*[columns[c].alias(f"v{i}") for i, c in enumerate(names)])
    exact = {f"v{i}" for i, t in enumerate(data.schema.fields) if isinstance(t.dataType, (T.IntegralType, T.DecimalType))}
    data = data.select(*[
        F.col(v) if v in exact else F.when(~F.isnan(F.col(v).cast("double")), F.col(v).cast("double")).alias(v) for v in data.columns
    ])
    col = {c: F.col(f"v{i}") for i, c in enumerate(names)}
    head = data.agg(*[
        e.alias(f"{k}{i}")
        for i, c in enumerate(names)
        for k, e in (("n", F.count(col[c])), ("lo", F.min(col[c])), ("hi", F.max(col[c])))
    ]).head()
    counts = {c: head[f"n{i}"] for i, c in enumerate(names)}
    found: dict[str, dict[int, float]] = {c: {} for c in names}
    searches: list[_Search] = []
    for i, c in enumerate(names):
        least, most = head[f"lo{i}"], head[f"hi{i}"]
        for r in sorted(set(ranks(c, counts[c]))) if counts[c] else []:
            if r == 0 or least == most:
                found[c][r] = least
            elif r == counts[c] - 1:
                found[c][r] = most
            else:
                searches.append(_Search(c, r, -math.inf, math.inf, counts[c]))
    while searches:
        wide = [s for s in searches if s.inside > max_rows]
        if wide:
            _narrow(data, col, wide, accuracy)
        small = [s for s in searches if s.value is None and s.inside <= max_rows]
        if small:
            _pick(data, col, small)
        for s in searches:
            if s.value is not None:
                found[s.name][s.rank] = s.value
        searches = [s for s in searches if s.value is None]
    return found, counts


def _inside(col, zone) -> Column:
    """The column where it lies in the open zone, else null."""
    name, low, high = zone
    c = col[name]
    tests = [t for t, end in ((c > F.lit(low), low), (c < F.lit(high), high)) if math.isfinite(end)]
    return F.when(tests[0] & tests[-1], c) if tests else c


def _narrow(data, col, searches, accuracy) -> None:
    """Sketch the rows still in play, take a bracket around each rank, then count to prove it."""
    margin = 2.0 / accuracy
    # neighbouring ranks of one column, such as the two around a quantile, share a bracket
    groups: list[list[_Search]] = []
    for s in sorted(searches, key=lambda s: (s.name, s.low, s.rank)):
        last = groups[-1][-1] if groups else None
        if last and last.zone == s.zone and s.rank - last.rank <= 1:
            groups[-1].append(s)
        else:
            groups.append([s])
    zones: dict[tuple, list[int]] = {}
    for g, members in enumerate(groups):
        zones.setdefault(members[0].zone, []).append(g)
    exprs = []
    for z, (zone, gs) in enumerate(zones.items()):
        probs = []
        for g in gs:
            first, last = groups[g][0], groups[g][-1]
            span = max(first.inside - 1, 1)
            probs += [(first.rank - first.below) / span - margin, (last.rank - last.below) / span + margin]
        probs = F.array(*[F.lit(min(max(p, 0.0), 1.0)) for p in probs])
        exprs.append(F.percentile_approx(_inside(col, zone), probs, accuracy).alias(f"q{z}"))
    row = data.agg(*exprs).head()
    brackets = {}
    for z, gs in enumerate(zones.values()):
        for k, g in enumerate(gs):
            brackets[g] = _bracket(groups[g][0], row[f"q{z}"][2 * k], row[f"q{z}"][2 * k + 1])

    # one pass counts the values below, on and between the bracket ends of every column
    ends: dict[str, list[float]] = {}
    for g, bracket in brackets.items():
        ends.setdefault(groups[g][0].name, []).extend(bracket)
    ends = {name: sorted(set(e)) for name, e in ends.items()}
    places, starts = {}, {}
    for name, edges in ends.items():
        starts[name] = sum(2 * len(ends[c]) + 1 for c in starts)
        places[name] = _place(col[name], edges, starts[name]) if len(edges) <= MAX_CASES or not _is_double(data, col[name]) else None
    many = {name for name in ends if len(ends[name]) > MAX_CASES and _is_double(data, col[name])}
    tally = {}
    if len(many) < len(ends):
        tagged = _tagged(data, [(tag, col[name]) for name, tag in places.items() if name not in many])
        tally = {r["tag"]: r["count"] for r in tagged.groupBy("tag").count().collect()}
    for name in many:
        tally.update(_tally(data, col[name], ends[name], starts[name]))
    for g, (low, high) in brackets.items():
        name = groups[g][0].name
        at = {e: starts[name] + 2 * i for i, e in enumerate(ends[name])}

        def total(stop):
            return sum(tally.get(t, 0) for t in range(starts[name], stop))

        below, to_low, to_inside, to_high = (
            total(stop) for stop in (at[low] + 1, at[low] + 2, at[high] + 1, at[high] + 2)
        )
        for s in groups[g]:
            before = s.inside
            if below <= s.rank < to_low:
                s.value = low
            elif to_inside <= s.rank < to_high:
                s.value = high
            elif s.rank < below:
                s.high, s.inside = low, below - s.below
            elif s.rank >= to_high:
                s.low, s.inside, s.below = high, s.inside - (to_high - s.below), to_high
            else:
                s.low, s.high, s.inside, s.below = low, high, to_inside - to_low, to_low
            s.stuck = s.inside == before


def _bracket(search: _Search, low, high) -> tuple:
    """The ends proposed by a sketch, which works in doubles, put inside the open zone of the search.

    Where the last pass gained nothing the middle of the zone is taken, so whole numbers beyond the reach of
    doubles are halved instead.
    """
    step = 1 if isinstance(low, int) else 0
    ends = sorted((low, high))
    if math.isfinite(search.low) and math.isfinite(search.high) and (search.stuck or (step and search.high - search.low < 4)):
        middle = search.low + (search.high - search.low) // 2 if step else (search.low + search.high) / 2
        return middle, middle
    if step and math.isfinite(search.low):
        ends = [max(e, search.low + 1) for e in ends]
    if step and math.isfinite(search.high):
        ends = [min(e, search.high - 1) for e in ends]
    return tuple(ends)


def _place(c: Column, edges: Sequence[float], start: int) -> Column:
    """Tag of a value among sorted edges: even steps from `start` between edges, odd ones on them."""
    tag = F.when(c < F.lit(edges[0]), F.lit(start))
    for i, edge in enumerate(edges):
        if i:
            tag = tag.when(c < F.lit(edge), F.lit(start + 2 * i))
        tag = tag.when(c == F.lit(edge), F.lit(start + 2 * i + 1))
    return tag.when(c.isNotNull(), F.lit(start + 2 * len(edges)))


def _is_double(data: DataFrame, c: Column) -> bool:
    return isinstance(data.select(c).schema[0].dataType, T.DoubleType)


def _tally(data: DataFrame, c: Column, edges: Sequence[float], start: int) -> dict[int, int]:
    """Number of values per tag of `_place`, by binary search: a chain of cases costs every row half of all edges."""
    ends = np.array(edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(2 * len(ends) + 1, dtype=np.int64)
        for batch in batches:
            v = batch.column(0).to_numpy(zero_copy_only=False)
            counts += np.bincount(np.searchsorted(ends, v, "left") + np.searchsorted(ends, v, "right"), minlength=len(counts))
        hit = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(start + hit, pa.int32()), pa.array(counts[hit])], ["tag", "n"])

    rows = data.select(c.alias("v")).where("v is not null").mapInArrow(run, "tag int, n long").groupBy("tag").agg(F.sum("n").alias("n"))
    return {r["tag"]: r["n"] for r in rows.collect()}


def _in_zones(data: DataFrame, c: Column, zones: Sequence[tuple[int, float, float]]) -> DataFrame:
    """(tag, v) of the values inside open zones (tag, low, high) that rise and do not overlap, by binary search."""
    tags, lows, highs = (np.array(x) for x in zip(*zones))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(0).to_numpy(zero_copy_only=False)
            at = np.searchsorted(lows, v, "left") - 1
            hit = np.flatnonzero((at >= 0) & (v < highs[at]))
            yield pa.RecordBatch.from_arrays([pa.array(tags[at[hit]], pa.int32()), pa.array(v[hit])], ["tag", "v"])

    return data.select(c.alias("v")).where("v is not null").mapInArrow(run, "tag int, v double")


def _tagged(data: DataFrame, pairs: Sequence[tuple[Column, Column]]) -> DataFrame:
    """Long rows (tag, value), untagged ones left out."""
    rows = F.inline(F.array(*[F.struct(tag.alias("tag"), v.alias("v")) for tag, v in pairs]))
    return data.select(rows).where(F.col("tag").isNotNull())


def _pick(data, col, searches) -> None:
    """Read each rank off the few rows of its bracket."""
    zones = sorted({s.zone for s in searches})
    # zones of one column that overlap go to different layers, so that each sees all its rows
    layers: list[tuple[str, float, Column]] = []
    of = {name: [(t, low, high) for t, (n, low, high) in enumerate(zones) if n == name] for name, _, _ in zones}
    many = {
        name for name, own in of.items() if len(own) > MAX_CASES and _is_double(data, col[name])
        and all(math.isfinite(end) for _, low, high in own for end in (low, high)) and all(a[2] <= b[1] for a, b in zip(own, own[1:]))
    }
    for t, (name, low, high) in enumerate(zones):
        if name in many:
            continue
        c = col[name]
        hit = c.isNotNull()
        if math.isfinite(low):
            hit = hit & (c > F.lit(low))
        if math.isfinite(high):
            hit = hit & (c < F.lit(high))
        for k, (owner, top, tag) in enumerate(layers):
            if owner == name and top <= low:
                layers[k] = (name, high, tag.when(hit, F.lit(t)))
                break
        else:
            layers.append((name, high, F.when(hit, F.lit(t))))
    offsets = [F.array(*[F.lit(s.rank - s.below + 1) for s in searches if s.zone == z]) for z in zones]
    wanted = F.element_at(F.array(*offsets), F.col("tag") + 1)
    found = [_in_zones(data, col[name], of[name]) for name in many]
    if layers:
        found.append(_tagged(data, [(tag, col[name]) for name, _, tag in layers]))
    rows = (
        reduce(DataFrame.unionByName, found)
        .groupBy("tag")
        .agg(F.sort_array(F.collect_list("v")).alias("vs"))
        .select("tag", F.transform(wanted, lambda k: F.element_at("vs", k)).alias("hits"))
        .collect()
    )
    hits = {zones[r["tag"]]: list(r["hits"]) for r in rows}
    for s in searches:
        s.value = hits[s.zone].pop(0)


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str] | Mapping[str, Column],
    probabilities: Sequence[float],
    **options,
) -> dict[str, list[float] | None]:
    """Quantiles by linear interpolation between order statistics, per column.

    None for a column without values.
    """
    exprs = columns if isinstance(columns, Mapping) else {c: F.col(c) for c in columns}

    def wanted(_: str, n: int) -> list[int]:
        spots = [(n - 1) * p for p in probabilities]
        return [r for h in spots for r in (math.floor(h), math.ceil(h))]

    values, counts = order_statistics(df, exprs, wanted, **options)
    out: dict[str, list[float] | None] = {}
    for name in exprs:
        n = counts[name]
        if not n:
            out[name] = None
            continue
        row = []
        for p in probabilities:
            h = (n - 1) * p
            low, high = float(values[name][math.floor(h)]), float(values[name][math.ceil(h)])
            row.append(low + (high - low) * (h - math.floor(h)))
        out[name] = row
    return out


def exact_median(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    return {c: q and q[0] for c, q in exact_quantiles(df, columns, [0.5]).items()}


def approximate_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], accuracy: int = SKETCH_ACCURACY
) -> DataFrame:
    """One-pass sketch for looks at very large tables: one row per column."""
    probs = F.array(*[F.lit(float(p)) for p in probabilities])
    row = df.agg(*[F.percentile_approx(c, probs, accuracy).alias(c) for c in columns])
    return row.unpivot([], list(columns), "variable", "quantiles")


def right_closed_bin(column: Column | str, breaks: Sequence[float]) -> Column:
    """Bin number 1..k for k+1 rising breaks; each bin has its upper break, bin 1 its lower one too.

    Null outside the breaks.
    """
    c = F.col(column) if isinstance(column, str) else column
    edges = sorted(set(breaks))
    number = F.when(c < F.lit(edges[0]), None)
    for i, edge in enumerate(edges[1:], 1):
        number = number.when(c <= F.lit(edge), F.lit(i))
    return number
