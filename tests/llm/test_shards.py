import glob
import os
import zlib

import numpy as np
import pytest
from lotline.llm import shards
from lotline.llm.common import table
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutation_is_one_to_one_and_keyed(n):
    slots = shards.permute(np.arange(n), n, "a")
    assert sorted(slots.tolist()) == list(range(n))
    if n > 100:
        other = shards.permute(np.arange(n), n, "b")
        assert (slots == other).mean() < 0.05 and (slots == np.arange(n)).mean() < 0.05


def plain_permute(i, n, key):
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        left, right = i >> half, i & mask
        for k in shards.round_keys(key).tolist():
            f = (right ^ k) * 0xFF51AFD7ED558CCD % 2**64
            f = (f ^ f >> 32) * 0xC4CEB9FE1A85EC53 % 2**64
            left, right = right, left ^ (f >> 29 & mask)
        i = left << half | right
        if i < n:
            return i


def test_permutation_equals_brute_force():
    assert shards.permute(np.arange(300), 300, "k").tolist() == [plain_permute(i, 300, "k") for i in range(300)]


def rebuilt(rows, width=1):
    """doc_id -> ids without the end id, from sequences in any order."""
    out = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"] if r["doc_id"] is not None else -1, r["seq"])):
        out.setdefault(r["doc_id"], []).append(bytes(r["tokens"]))
    return {k: b"".join(v)[:-width] for k, v in out.items()}


def test_round_trip_of_a_whole_table(spark, tmp_path):
    docs, path = table(spark, SF, "documents"), str(tmp_path / "out")
    layout = shards.materialise(docs, path, shard_bytes=100_000)
    rows = shards.read_sequences(spark, path, layout).collect()
    assert sorted(r["slot"] for r in rows) == list(range(layout.n)) and layout.shards > 3
    assert rebuilt(rows) == {r["doc_id"]: r["text"].encode() for r in docs.collect()}
    files = glob.glob(f"{path}/shard=*/part-*")
    assert len(files) == layout.shards
    for r in rows[:: len(rows) // 40]:
        assert layout.place(r["slot"]) == (r["shard"], r["byte_offset"])
        name = glob.glob(f"{path}/shard={r['shard']}/part-*")[0]
        with open(name, "rb") as f:
            f.seek(r["byte_offset"] + shards.HEADER.itemsize)
            assert f.read(r["n_tokens"]) == bytes(r["tokens"])
    assert sum(os.path.getsize(f) for f in files) == layout.n * layout.stride + layout.shards


def test_reading_resumes_at_any_slot(spark, tmp_path):
    docs, path = table(spark, SF, "documents"), str(tmp_path / "out")
    layout = shards.materialise(docs, path, shard_bytes=50_000)
    got = shards.read_sequences(spark, path, layout, 137, 600).select("slot").collect()
    assert sorted(r["slot"] for r in got) == list(range(137, 601))


def test_same_table_and_key_give_the_same_order(spark, tmp_path):
    docs = table(spark, SF, "documents")
    found = []
    for name, key in (("a", "k"), ("b", "k"), ("c", "other")):
        layout = shards.materialise(docs, str(tmp_path / name), key=key)
        found.append({(r["doc_id"], r["seq"], r["slot"]) for r in shards.read_sequences(spark, str(tmp_path / name), layout).collect()})
    assert found[0] == found[1] != found[2]


def test_edge_rows_and_wide_ids(spark, docs_of, tmp_path):
    rows = [(1, None), (2, ""), (3, "é🙂"), (4, "x" * 511), (5, "x" * 512), (6, "long " * 50_000), (None, "no id")]
    docs = docs_of(rows, extra=("slot", "shard"))
    layout = shards.materialise(docs, str(tmp_path / "a"))
    got = shards.read_sequences(spark, str(tmp_path / "a"), layout).collect()
    assert rebuilt(got) == {i: (t or "").encode() for i, t in rows}
    assert sorted(r["n_tokens"] for r in got if r["doc_id"] in (4, 5)) == [1, 512, 512]
    ids = np.array([5, 70_000 % 65_536, 9], dtype="<u2").tobytes()
    wide = docs_of([(1, "a")]).withColumn("ids", F.lit(ids))
    layout = shards.materialise(wide, str(tmp_path / "b"), tokens=F.col("ids"), width=2, length=2, end=7, pad=0)
    got = shards.read_sequences(spark, str(tmp_path / "b"), layout).collect()
    assert layout.n == 2 and rebuilt(got, width=2) == {1: ids}
    digest = shards.digests(shards.read_sequences(spark, str(tmp_path / "b"), layout)).where("seq = 0").head()
    assert digest["tokens_crc32"] == zlib.crc32(ids[:4])
    twice = docs_of([(1, "a"), (1, "a")])
    assert shards.materialise(twice, str(tmp_path / "d")).n == 2


def test_empty_table(spark, docs_of, tmp_path):
    layout = shards.materialise(docs_of([(1, "a")]).where("doc_id > 5"), str(tmp_path / "e"))
    assert layout.n == 0 and shards.read_sequences(spark, str(tmp_path / "e"), layout).collect() == []
