import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lotline.llm import negatives
from lotline.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
ORDER = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows, anchors, positives=5, keep=3, low=50, high=95):
    """Every pair, by plain whole numbers."""
    known = {}
    for vec_id, vec, label in rows:
        if vec_id is None or label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        row = (label, [math.floor(256 * x) for x in vec])
        known[vec_id] = min(known.get(vec_id, row), row)
    out = []
    for a in sorted(i for i in known if anchors(i)):
        label, vec = known[a]
        score = {i: sum(x * y for x, y in zip(vec, v)) for i, (_, v) in known.items() if i != a}
        ranked = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in ranked if known[i][0] == label][:positives]:
            fits = [i for i in ranked if known[i][0] != label and low * score[p] <= 100 * score[i] <= high * score[p]]
            out += [(a, p, k, i, score[p], score[i]) for k, i in enumerate(fits[:keep], 1)]
    return sorted(out)


def check(spark, rows, anchors, condition, extra=False):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows] if extra else rows,
                               "vec_id long, embedding array<double>, label int" + (", vec string, anchor int" if extra else ""))
    got = negatives.hard_negatives(df, condition)
    assert got.columns == ORDER
    assert sorted(map(tuple, got.collect())) == plain(rows, anchors)


def near_copies(n, dims, centres, seed):
    rng = random.Random(seed)
    heads = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(centres)]
    rows = []
    for i in range(n):
        vec = [x + rng.gauss(0, 0.25) for x in heads[i % centres]]
        size = math.sqrt(sum(x * x for x in vec)) or 1
        rows.append((i, [x / size for x in vec], rng.randrange(3)))
    return rows


def test_query_against_sql(spark):
    db = duckdb.connect()
    db.sql(f"create view embeddings as from '{SF}/embeddings.parquet'")
    expected = sorted(db.sql(negatives.CONTRACT_SQL).fetchall())
    assert sorted(map(tuple, QUERIES["op11_hard_negatives"](spark, SF).collect())) == expected and expected


def test_many_blocks_clusters_and_segments(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_BYTES", 8 * 320)
    monkeypatch.setattr(negatives, "CLUSTER_ANCHORS", 4)
    monkeypatch.setattr(negatives, "SEED_ROWS", 7)
    monkeypatch.setattr(negatives, "SEGMENT_ROWS", 100)
    rows = near_copies(600, 8, 9, 1)
    check(spark, rows, lambda i: i % 10 == 0, F.col("vec_id") % 10 == 0)


def test_missing_parts_ties_repeats_and_odd_lengths(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.5]) for _ in range(4)], rng.randrange(2)) for i in range(80)]
    rows += [(100, None, 1), (101, [], 1), (102, [0.5, None, 0.1, 0.1], 0), (103, [float("nan")] * 4, 0), (104, [float("inf")] * 4, 1)]
    rows += [(105, [0.5], 0), (106, [0.5, 0.5], 1), (107, [0.25] * 9, 0), (None, [0.5] * 4, 1), (108, [0.5] * 4, None), (109, [0.0] * 4, 1)]
    rows += [rows[3], rows[3], (3, [0.5, 0.5, 0.5, 0.5], 0), (110, [-0.5] * 4, 7)]
    check(spark, rows, lambda i: i % 5 == 0 or i > 100, (F.col("vec_id") % 5 == 0) | (F.col("vec_id") > 100), extra=True)


def test_one_vector_with_a_third_of_all_rows(spark):
    hot = [0.6, 0.0, 0.8]
    rows = [(i, hot, i % 3 == 0 and 1 or 0) for i in range(300)] + [(300 + r[0], r[1], r[2]) for r in near_copies(600, 3, 40, 2)]
    check(spark, rows, lambda i: i % 50 == 0, F.col("vec_id") % 50 == 0)


def test_large_components_stay_exact(spark):
    rows = [(i, [4000.0 * (i % 7), -3000.0 * (i % 5), 1.0 * i], i % 2) for i in range(60)]
    check(spark, rows, lambda i: i % 6 == 0, F.col("vec_id") % 6 == 0)
    huge = spark.createDataFrame([(i, [1e300 * (1 + i % 3), 1.0], i % 2) for i in range(12)], "vec_id long, embedding array<double>, label int")
    got = negatives.hard_negatives(huge, F.col("vec_id") == 0, low=50, high=100).collect()
    assert got and all(r["positive_score"] > 2**60 for r in got)


@pytest.mark.parametrize("rows", [[], [(1, [0.5], 1)], [(50, [0.5], 1), (51, [0.4], 2)], [(50, [-0.5], 1), (51, [0.4], 1), (52, [0.2], 2)]])
def test_nothing_to_find(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert negatives.hard_negatives(df, F.col("vec_id") % 50 == 0).collect() == []


def test_window_is_exact():
    for score in [*range(-250, 250), 2**61 + 7, -(2**61) - 3]:
        least, most = negatives.window(np.array([score]))
        assert int(least[0]) == -((-50 * score) // 100) and int(most[0]) == 95 * score // 100


def test_the_walk_stops_early_on_clustered_vectors():
    import pyarrow as pa

    rng = np.random.default_rng(3)
    heads = rng.normal(size=(20, 32))
    vectors = np.floor(256 * negatives._units(heads[rng.integers(0, 20, 8_000)] + rng.normal(0, 0.1, (8_000, 32)))).astype(np.int64)
    own = vectors[:40]
    centres = negatives.fit_centres(own, 20)
    cosine = np.clip(negatives._units(own) @ centres.T, -1, 1)
    cluster = cosine.argmax(axis=1)
    widest = np.zeros(20)
    np.maximum.at(widest, cluster, np.arccos(cosine.max(axis=1)) + 1e-7)
    block = pa.table({"anchor_id": pa.array(range(40)), "label": pa.array([0] * 40), "vec": pa.array(own.tolist(), pa.list_(pa.int32())),
                      "cluster": pa.array(cluster, pa.int32()), "floor": pa.array([np.iinfo(np.int64).min] * 40)})
    members = negatives.Members(block, centres, widest, 32)
    kept = negatives.SameLabel(members, 5)
    ids, label = np.arange(8_000), np.zeros(8_000, dtype=np.int64)
    scored = members.walk(vectors, kept.needed, lambda at, part, score: kept.found(at, ids[part], label[part], score))
    assert scored < 0.5 * 40 * 8_000
    exact = members.vec @ vectors.T
    exact[np.arange(40), members.ids] = np.iinfo(np.int64).min
    assert (kept.best.score == np.sort(exact, axis=1)[:, :-6:-1]).all()
