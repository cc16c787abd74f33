"""Hard negatives by shared candidate lists of anchor clusters, in the manner of MAXIMUS.

Anchors are clustered by angle. With t the largest angle between a member of a cluster and its centre, a
candidate of norm r at the angle a from the centre scores at most r * cos(max(0, a - t)) times the norm of the
member. The candidates are sorted by this bound once per cluster, and every member walks the shared list until the
bound certifies that nothing further on can change its result.

The list lies in segments, one per batch of candidates in a task; a task keeps what it has found from segment to
segment. Anchors go to the tasks in blocks of bounded size, candidates never move. Scores on a small sample
of candidates give every walk a first limit, so only near-final finds leave a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotline.llm.common import small_batches
from lotline.staging import stage, stage_observed

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95  # a negative's score lies within so many hundredths of the positive's
# anchors that a cluster is meant for, and the most clusters: centres stay a small table
CLUSTER_ANCHORS = 64
MAX_CLUSTERS = 256
# bounds of the samples: anchors that the centres are fitted on, candidates that give the first limits
FIT_ANCHORS = 8_192
SEED_ROWS = 4_096
# bytes of anchors that go to the tasks at once, candidates in one segment, candidates in the first
# step of a walk (steps double), scores in one step
BLOCK_BYTES = 8 << 20
SEGMENT_ROWS = 32_768
STEP = 256
CELLS = 1 << 18
_NONE = np.iinfo(np.int64).min
_LAST = np.iinfo(np.int64).max

CONTRACT_SQL = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), s as (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same, cast(list_dot_product(a.e, b.e) as bigint) as score
  from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id
), p as (
  select anchor_id, other_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
)
select anchor_id, positive_id, cast(row_number() over w as int) as rank, other_id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id)
where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
window w as (partition by anchor_id, positive_id order by score desc, other_id)
qualify row_number() over w <= 3
"""


def quantised(rows: DataFrame, anchor: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = SCALE) -> DataFrame:
    """(vec_id, label, vec array<int>, anchor boolean): rows that take part, components as floor(scale * x).

    A null id, label, vector or component and a component that is not finite leave a row out. Components are held
    within 2^31 / sqrt(length), so that no score leaves 64 bits. Of rows that repeat an id the one with the smallest
    (label, vector) stands for it.
    """
    limit = F.floor(F.lit(2.0**31) / F.sqrt(F.greatest(F.size("vec"), F.lit(4)).cast("double"))).cast("double")
    known = rows.select(
        rows[vec_id].cast("long").alias("vec_id"), rows[label].cast("long").alias("label"),
        rows[vector].cast("array<double>").alias("vec"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
    )
    odd = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = known.where("vec_id is not null and label is not null and vec is not null").where(~odd)
    parts = F.transform("vec", lambda x: F.floor(F.greatest(F.least(x * scale, limit), -limit)).cast("int"))
    one = whole.select("vec_id", F.struct("label", parts.alias("vec"), "anchor").alias("row")).groupBy("vec_id").agg(F.min("row").alias("row"))
    return one.select("vec_id", "row.label", "row.vec", "row.anchor")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of whole numbers, short ones filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _exact_kind(a: np.ndarray, b: np.ndarray) -> type:
    """The narrowest number that rounds no partial sum of an inner product of rows of these norms, by Cauchy and Schwarz."""
    most = a.max(initial=0) * b.max(initial=0)
    return np.float32 if most < 2**23 else np.float64 if most < 2**52 else np.int64


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows."""
    kind = _exact_kind(_norms(a), _norms(b))
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


def _norms(a: np.ndarray) -> np.ndarray:
    return np.sqrt((a.astype(np.float64) ** 2).sum(axis=1))


def _units(a: np.ndarray) -> np.ndarray:
    return a / np.maximum(_norms(a), 1e-300)[:, None]


def fit_centres(vectors: np.ndarray, clusters: int, rounds: int = 6) -> np.ndarray:
    """Unit centres of a sample of vectors by spherical k-means from an even start."""
    units = _units(vectors)
    centres = units[np.linspace(0, len(units) - 1, clusters).astype(int)]
    for _ in range(rounds):
        own = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, units)
        empty = ~sums.any(axis=1)
        centres = np.where(empty[:, None], centres, _units(sums))
    return centres


class Best:
    """The best finds of each of some queries: higher scores first, ties by smaller id; repeats of an id do not occur."""

    def __init__(self, queries: int, keep: int, floor: np.ndarray):
        self.keep, self.floor = keep, floor
        self.score = np.full((queries, keep), _NONE)
        self.ids = np.full((queries, keep), _LAST)

    def limit(self) -> np.ndarray:
        """Scores below it cannot be among the best."""
        return np.maximum(self.floor, self.score[:, -1])

    def better(self, at: np.ndarray, score: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Which of the scores, one row per query of `at`, would come in."""
        last, last_id = self.score[at, -1][:, None], self.ids[at, -1][:, None]
        return (score >= self.floor[at][:, None]) & ((score > last) | ((score == last) & (ids < last_id)))

    def take(self, rows: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Sort finds into the queries of `rows`."""
        touched = np.unique(rows)
        rows = np.concatenate((rows, np.repeat(touched, self.keep)))
        score = np.concatenate((score, self.score[touched].ravel()))
        ids = np.concatenate((ids, self.ids[touched].ravel()))
        order = np.lexsort((ids, ~score, rows))
        rows, score, ids = rows[order], score[order], ids[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        stay = place < self.keep
        self.score[rows[stay], place[stay]] = score[stay]
        self.ids[rows[stay], place[stay]] = ids[stay]


class Members:
    """Anchors of a block in the order of their clusters, with the walk over a segment that they share."""

    def __init__(self, block: pa.Table, centres: np.ndarray, widest: np.ndarray, width: int):
        block = block.combine_chunks()
        order = np.lexsort((block["anchor_id"].to_numpy(), block["cluster"].to_numpy()))
        block = block.take(pa.array(order)).combine_chunks()
        self.table = block
        self.ids, self.label = block["anchor_id"].to_numpy(), block["label"].to_numpy()
        self.vec = _matrix(block["vec"].chunk(0), width)
        self.norm = _norms(self.vec)
        cluster = block["cluster"].to_numpy()
        self.clusters, self.starts = np.unique(cluster, return_index=True)
        self.ends = np.append(self.starts[1:], len(cluster))
        self.centres, self.widest = centres[self.clusters], widest[self.clusters]

    def walk(self, vectors: np.ndarray, needed: Callable[[np.ndarray], np.ndarray], found: Callable) -> int:
        """Walk the list of every cluster over one segment of candidates; the pairs scored.

        `needed` gives the least score that can still matter to each of some members; `found` gets members,
        places of candidates in the segment, and their scores.
        """
        norm, scored = _norms(vectors), 0
        kind = _exact_kind(self.norm, norm)
        own, others = self.vec.astype(kind), vectors.astype(kind)
        slack = 1e-6 * norm.max(initial=0)
        cosine = np.clip(_units(vectors) @ self.centres.T, -1, 1)
        for c, (start, end) in enumerate(zip(self.starts, self.ends)):
            bound = norm * np.cos(np.maximum(0, np.arccos(cosine[:, c]) - self.widest[c]))
            order = np.argsort(-bound, kind="stable")
            members, at, step = np.arange(start, end), 0, STEP
            while at < len(order):
                # a bound below zero is nearest to zero for the shortest member, hence the product with each norm
                reach = self.norm[members] * (bound[order[at]] + slack) + 1e-3
                members = members[reach >= needed(members)]
                if not len(members):
                    break
                part = order[at : at + min(step, max(STEP, CELLS // len(members)))]
                found(members, part, (own[members] @ others[part].T).astype(np.int64))
                scored += len(members) * len(part)
                at, step = at + len(part), 2 * step
        return scored


class SameLabel:
    """Collects the best other rows of the label of each anchor."""

    columns = "anchor_id long, positive_id long, positive_score long"

    def __init__(self, members: Members, keep: int):
        self.members = members
        self.best = Best(len(members.ids), keep, members.table["floor"].to_numpy())

    def needed(self, at: np.ndarray) -> np.ndarray:
        return self.best.limit()[at]

    def found(self, at: np.ndarray, ids: np.ndarray, label: np.ndarray, score: np.ndarray) -> None:
        m = self.members
        fits = (label == m.label[at][:, None]) & (ids != m.ids[at][:, None]) & self.best.better(at, score, ids)
        i, j = np.nonzero(fits)
        if len(i):
            self.best.take(at[i], score[i, j], ids[j])

    def result(self) -> pa.RecordBatch:
        i, j = np.nonzero(self.best.score != _NONE)
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (self.members.ids[i], self.best.ids[i, j], self.best.score[i, j])],
            ["anchor_id", "positive_id", "positive_score"],
        )


class OtherLabel:
    """Collects, for each anchor and positive, the best rows of other labels within the window of the positive."""

    columns = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"

    def __init__(self, members: Members, keep: int, low: int, high: int):
        self.members = members
        lists = members.table["positives"].chunk(0)
        own, flat = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy())), lists.flatten()
        score, ids, floor = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("positive_score", "positive_id", "floor"))
        place = np.arange(len(own)) - np.searchsorted(own, own)
        self.width = int(place.max(initial=-1)) + 1
        shape = (len(lists), self.width)
        # no positive in a place: a window that nothing fits
        self.positive, self.score = np.full(shape, _LAST), np.zeros(shape, dtype=np.int64)
        self.low, self.high, floors = np.full(shape, _LAST), np.full(shape, _NONE), np.full(shape, _LAST)
        self.positive[own, place], self.score[own, place] = ids, score
        self.low[own, place], self.high[own, place] = window(score, low, high)
        floors[own, place] = np.maximum(floor, self.low[own, place])
        self.best = [Best(len(lists), keep, floors[:, p]) for p in range(self.width)]
        self.open = self.low <= self.high

    def needed(self, at: np.ndarray) -> np.ndarray:
        least = np.full(len(at), _LAST)
        for p, best in enumerate(self.best):
            least = np.where(self.open[at, p], np.minimum(least, best.limit()[at]), least)
        return least

    def found(self, at: np.ndarray, ids: np.ndarray, label: np.ndarray, score: np.ndarray) -> None:
        other = label != self.members.label[at][:, None]
        for p, best in enumerate(self.best):
            i, j = np.nonzero(other & (score <= self.high[at, p][:, None]) & best.better(at, score, ids))
            if len(i):
                best.take(at[i], score[i, j], ids[j])

    def result(self) -> pa.RecordBatch:
        parts = []
        for p, best in enumerate(self.best):
            i, j = np.nonzero(best.score != _NONE)
            parts.append((self.members.ids[i], self.positive[i, p], self.score[i, p], best.ids[i, j], best.score[i, j]))
        names = [c.split()[0] for c in self.columns.split(", ")]
        merged = [np.concatenate([x[k] for x in parts]) if parts else np.zeros(0, dtype=np.int64) for k in range(5)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in merged], names)


def window(score: np.ndarray, low: int = LOW, high: int = HIGH) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest whole number n with low * score <= 100 * n <= high * score, without leaving 64 bits."""
    whole, rest = np.divmod(score, 100)
    return whole * low - (-(rest * low) // 100), whole * high + (rest * high) // 100


def _segments(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, vectors) of about SEGMENT_ROWS candidates at a time, by id."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= SEGMENT_ROWS:
            yield _segment(held, width)
            held, n = [], 0
    if n:
        yield _segment(held, width)


def _segment(held: list[pa.RecordBatch], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.concatenate([b.column("vec_id").to_numpy() for b in held])
    order = np.argsort(ids)
    label = np.concatenate([b.column("label").to_numpy() for b in held])
    return ids[order], label[order], np.concatenate([_matrix(b.column("vec"), width) for b in held])[order]


def _walk_all(rows: DataFrame, blocks: Iterator[pa.Table], centres: np.ndarray, widest: np.ndarray, width: int, collect: type, options: tuple, name: str) -> DataFrame:
    """The finds of all blocks of anchors over all rows, each block's staged; a find per task at most where several tasks see an anchor."""
    spark = rows.sparkSession

    def walker(sent):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            members = Members(*sent.value, width)
            kept = collect(members, *options)
            for ids, label, vectors in _segments(batches, width):
                members.walk(vectors, kept.needed, lambda at, part, score: kept.found(at, ids[part], label[part], score))
            yield kept.result()

        return run

    out = spark.createDataFrame([], collect.columns)
    for block in blocks:
        sent = spark.sparkContext.broadcast((block, centres, widest))
        out = out.unionByName(stage(rows.select("vec_id", "label", "vec").mapInArrow(walker(sent), collect.columns), name))
        sent.destroy()
    return out


def _seed_floor(sample: tuple[np.ndarray, np.ndarray, np.ndarray], ids, label, vec, keep: int) -> np.ndarray:
    """The score of each anchor's worst of `keep` best rows of its label in the sample; none if there are fewer."""
    seed_ids, seed_label, seed_vec = sample
    score = _products(vec, seed_vec)
    score[(label[:, None] != seed_label) | (ids[:, None] == seed_ids)] = _NONE
    return _kth(score, keep)


def _kth(score: np.ndarray, keep: int) -> np.ndarray:
    if score.shape[1] < keep:
        return np.full(len(score), _NONE)
    return np.partition(score, score.shape[1] - keep, axis=1)[:, -keep]


def hard_negatives(rows: DataFrame, anchor: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
                   positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows where `anchor` holds.

    Scores are integer inner products of `quantised` vectors; vectors of different length are compared over the
    components that both have. An anchor's positives are its first `positives` other rows of its label, by higher
    score, then smaller id; each gets its first `negatives` rows of other labels whose score lies within
    low..high hundredths of the positive's. Anchors without positives, and positives without a fitting row, give no row.
    Null ids, labels, vectors and components leave a row out, as `quantised` says; an empty table gives an empty result.
    Results are exact: the bound is certified, with room for rounding.
    """
    spark = rows.sparkSession
    small_batches(spark)
    staged, seen = stage_observed(quantised(rows, anchor, vec_id, vector, label), "vectors", {
        "width": F.max(F.size("vec")), "anchors": F.sum(F.col("anchor").cast("long")),
    })
    width, n = int(seen["width"] or 0), int(seen["anchors"] or 0)
    shape = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n:
        return spark.createDataFrame([], shape)

    def sampled(table: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        got = table.orderBy(F.xxhash64("vec_id"), "vec_id").limit(most).select("vec_id", "label", "vec").toArrow().combine_chunks()
        return _segment(got.to_batches(), width)

    chosen = staged.where("anchor")
    centres = fit_centres(sampled(chosen, FIT_ANCHORS)[2], min(MAX_CLUSTERS, -(-n // CLUSTER_ANCHORS)))
    sample = spark.sparkContext.broadcast((centres, sampled(staged, SEED_ROWS)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, seeds = sample.value
        for batch in batches:
            ids, own, vec = (batch.column("vec_id").to_numpy(), batch.column("label").to_numpy(), _matrix(batch.column("vec"), width))
            cosine = np.clip(_units(vec) @ centres.T, -1, 1)
            cluster = cosine.argmax(axis=1)
            # an anchor of zeros scores zero with everything and widens no cluster
            angle = np.where(vec.any(axis=1), np.arccos(cosine[np.arange(len(vec)), cluster]), 0)
            floor = _seed_floor(seeds, ids, own, vec, positives)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), batch.column("vec"), pa.array(cluster, pa.int32()), pa.array(angle), pa.array(floor)],
                ["anchor_id", "label", "vec", "cluster", "angle", "floor"],
            )

    kinds = "anchor_id long, label long, vec array<int>, cluster int, angle double, floor long"
    anchors = stage(chosen.select("vec_id", "label", "vec").mapInArrow(assign, kinds), "anchors")
    sizes = anchors.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("widest")).collect()
    widest = np.zeros(len(centres))
    for r in sizes:
        widest[r["cluster"]] = r["widest"] + 1e-7
    cuts = list(block_filters({r["cluster"]: r["n"] for r in sizes}, max(1, BLOCK_BYTES // (8 * width + 256))))

    def blocks(table: DataFrame) -> Iterator[pa.Table]:
        return (table.where(cut).toArrow() for cut in cuts)

    by_score = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    same = _walk_all(staged, blocks(anchors), centres, widest, width, SameLabel, (positives,), "positives")
    best = same.withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= positives)
    lists = best.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("positive_score", "positive_id"))).alias("positives"))

    def limits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, (_, seed_label, seed_vec) = sample.value
        for batch in batches:
            own, vec, found = batch.column("label").to_numpy(), _matrix(batch.column("vec"), width), batch.column("positives")
            score, row = found.flatten().field("positive_score").to_numpy(), np.repeat(np.arange(len(vec)), np.diff(found.offsets.to_numpy()))
            seeds = _products(vec, seed_vec)
            least, most = window(score, low, high)
            fits = (own[row][:, None] != seed_label) & (seeds[row] >= least[:, None]) & (seeds[row] <= most[:, None])
            floor = _kth(np.where(fits, seeds[row], _NONE), negatives)
            whole = pa.StructArray.from_arrays([*found.flatten().flatten(), pa.array(floor)], ["positive_score", "positive_id", "floor"])
            arrays = [batch.column(c) for c in ("anchor_id", "label", "vec", "cluster")] + [pa.ListArray.from_arrays(pa.array(found.offsets.to_numpy() - found.offsets[0].as_py(), pa.int32()), whole)]
            yield pa.RecordBatch.from_arrays(arrays, ["anchor_id", "label", "vec", "cluster", "positives"])

    kinds = "anchor_id long, label long, vec array<int>, cluster int, positives array<struct<positive_score:long,positive_id:long,floor:long>>"
    ready = stage(anchors.join(lists, "anchor_id").select("anchor_id", "label", "vec", "cluster", "positives").mapInArrow(limits, kinds), "windows")
    found = _walk_all(staged, (b for b in blocks(ready) if b.num_rows), centres, widest, width, OtherLabel, (negatives, low, high), "negatives")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def block_filters(sizes: dict[int, int], most: int) -> Iterator[Column]:
    """Conditions that cut the anchors into blocks of about `most` rows: whole clusters together, a large one by a hash of the id."""
    pack, total = [], 0
    for cluster, n in sorted(sizes.items()):
        if n > most:
            slices = -(-n // most)
            for i in range(slices):
                yield (F.col("cluster") == cluster) & (F.pmod(F.xxhash64("anchor_id"), F.lit(slices)) == i)
            continue
        if total + n > most:
            yield F.col("cluster").isin(pack)
            pack, total = [], 0
        pack, total = [*pack, cluster], total + n
    if pack:
        yield F.col("cluster").isin(pack)
