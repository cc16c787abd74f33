"""Training-order materialisation: token sequences in fixed-stride shard files, in a keyed random order.

Every document's token ids, closed by an end id, are cut into sequences of fixed length. A keyed Feistel permutation
with cycle-walking gives each sequence its global slot, so the order needs no sort key to be stored and no shuffle
buffer when read. Slots are dealt to shards by range; a shard is one file of equal records in slot order, so the
record of a slot lies at a known byte and reading can resume at any slot.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotline.llm.common import small_batches
from lotline.staging import stage

LENGTH = 512
SHARD_BYTES = 16 << 20
ROUNDS = 6
KEY = "training-order"
# bytes of records that a task holds before it hands them on by shard
HELD_BYTES = 32 << 20
END, PAD = 0xFF, 0xFE  # neither occurs in UTF-8
HEADER = np.dtype([("doc_id", "<i8"), ("no_id", "<i4"), ("seq", "<i4"), ("n_tokens", "<i4"), ("slot", "<i8")])


@dataclass(frozen=True)
class Layout:
    """What is needed to find a slot: sequences, ids per sequence, bytes per id, slots per shard."""

    n: int
    length: int = LENGTH
    width: int = 1
    per_shard: int = 1

    @property
    def stride(self) -> int:
        return HEADER.itemsize + self.length * self.width

    @property
    def shards(self) -> int:
        return -(-self.n // self.per_shard)

    def place(self, slot: int) -> tuple[int, int]:
        """(shard, byte offset) of a slot."""
        return slot // self.per_shard, slot % self.per_shard * self.stride


def round_keys(key: str, rounds: int = ROUNDS) -> np.ndarray:
    digest = hashlib.shake_256(key.encode()).digest(8 * rounds)
    return np.frombuffer(digest, dtype="<u8").copy()


def permute(index: np.ndarray, n: int, key: str = KEY) -> np.ndarray:
    """Slots of the indices under a keyed permutation of 0 ... n-1.

    A balanced Feistel network permutes the next power of four; a value at or beyond n is permuted again until it
    falls below, which keeps it one-to-one. On average under four rounds of walking.
    """
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = round_keys(key)
    out = np.asarray(index, dtype=np.uint64).copy()
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> half, x & mask
        for k in keys:
            f = (right ^ k) * np.uint64(0xFF51AFD7ED558CCD)
            f = (f ^ (f >> np.uint64(32))) * np.uint64(0xC4CEB9FE1A85EC53)
            left, right = right, left ^ ((f >> np.uint64(29)) & mask)
        x = (left << half) | right
        out[todo] = x
        todo = todo[x >= np.uint64(n)]
    return out.astype(np.int64)


def cut(ids: bytes, length: int, width: int, end: int, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows of bytes, tokens per row) of one document's ids with the end id, the last row padded."""
    one = lambda x: int(x).to_bytes(width, "little")
    n = len(ids) // width + 1
    rows = -(-n // length)
    raw = ids + one(end) + one(pad) * (rows * length - n)
    sizes = np.full(rows, length, dtype=np.int32)
    sizes[-1] = n - (rows - 1) * length
    return np.frombuffer(raw, dtype=np.uint8).reshape(rows, length * width), sizes


def _numbered(docs: DataFrame, tokens: Column) -> DataFrame:
    """(block, doc_id, tokens): rows of a stored table with the block of the file that one task reads in order."""
    block = F.xxhash64("_metadata.file_path", "_metadata.file_block_start")
    return docs.select(block.alias("block"), docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(tokens, F.lit(b"")).alias("tokens"))


def materialise(
    docs: DataFrame, path: str, tokens: Column | None = None, key: str = KEY, length: int = LENGTH, width: int = 1,
    end: int = END, pad: int = PAD, shard_bytes: int = SHARD_BYTES,
) -> Layout:
    """Write the shards of a document table under `path` and return their layout.

    `tokens` is a binary column of ids of `width` bytes each, little endian; by default the UTF-8 bytes of `text`.
    Sequences are numbered in the order of the stored table, block by block; the driver holds one number per block. A frame
    that is not a plain table scan is stored first. Null tokens are an empty document, which is one sequence
    with the end id. Repeated rows are sequences of their own; null ids are marked as such. An empty table writes no shard.
    """
    spark = docs.sparkSession
    small_batches(spark)
    tokens = F.col("text").cast("string").cast("binary") if tokens is None else tokens
    try:
        rows = _numbered(docs, tokens)
        rows.schema  # noqa: B018  (tells a scan from other frames)
    except AnalysisException:
        rows = _numbered(stage(docs.select("doc_id", tokens.alias("tokens")), "tokens"), F.col("tokens"))
    n_rows = F.ceil((F.octet_length("tokens") / width + 1) / length)
    blocks = rows.groupBy("block").agg(F.sum(n_rows).cast("long").alias("n")).orderBy("block").collect()
    starts, n = {}, 0
    for b in blocks:
        starts[b["block"]] = n
        n += b["n"]
    stride = HEADER.itemsize + length * width
    layout = Layout(n, length, width, max(1, shard_bytes // stride))
    if not n:
        return layout
    shared = spark.sparkContext.broadcast(starts)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for block, doc_id, ids in zip(*(batch.column(c).to_pylist() for c in ("block", "doc_id", "tokens"))):
                body, sizes = cut(ids, length, width, end, pad)
                first = shared.value[block] + seen.get(block, 0)
                seen[block] = seen.get(block, 0) + len(body)
                head = np.zeros(len(body), dtype=HEADER)
                head["doc_id"], head["no_id"] = doc_id or 0, doc_id is None
                head["seq"], head["n_tokens"] = np.arange(len(body)), sizes
                head["slot"] = np.arange(first, first + len(body))
                held.append(np.concatenate((head.view(np.uint8).reshape(len(body), -1), body), axis=1))
                size += held[-1].nbytes
                if size >= HELD_BYTES:
                    yield _by_shard(held, layout, key)
                    held, size = [], 0
        if held:
            yield _by_shard(held, layout, key)

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for shard, packed in zip(batch.column("shard").to_pylist(), batch.column("records").to_pylist()):
                raw = np.frombuffer(zstandard.decompress(packed), dtype=np.uint8)
                parts.setdefault(shard, []).append(raw.reshape(-1, layout.stride))
        for shard in sorted(parts):
            records = np.concatenate(parts.pop(shard))
            slots = np.ascontiguousarray(records[:, : HEADER.itemsize]).view(HEADER)["slot"].ravel()
            content = records[np.argsort(slots)].tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([content], pa.binary())], ["shard", "content"])

    dealt = rows.mapInArrow(deal, "shard int, records binary").repartitionById(layout.shards, F.col("shard"))
    whole = dealt.mapInArrow(assemble, "shard int, content binary")
    # the text sink writes the bytes as they are and one line end after each shard
    whole.select("shard", F.col("content").cast("string").alias("content")).write.partitionBy("shard").text(path)
    return layout


def _by_shard(held: list[np.ndarray], layout: Layout, key: str) -> pa.RecordBatch:
    """One compressed block of records per shard, with the index in each header replaced by its slot."""
    records = np.concatenate(held)
    head = np.ascontiguousarray(records[:, : HEADER.itemsize]).view(HEADER).ravel()
    head["slot"] = permute(head["slot"], layout.n, key)
    records[:, : HEADER.itemsize] = head.view(np.uint8).reshape(len(head), -1)
    shard = head["slot"] // layout.per_shard
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order], prepend=-1))
    packer = zstandard.ZstdCompressor(level=3)
    packed = [packer.compress(records[part].tobytes()) for part in np.split(order, cuts[1:])]
    return pa.RecordBatch.from_arrays([pa.array(shard[order][cuts], pa.int32()), pa.array(packed, pa.binary())], ["shard", "records"])


def read_sequences(spark: SparkSession, path: str, layout: Layout, first_slot: int = 0, last_slot: int | None = None) -> DataFrame:
    """(slot, shard, byte_offset, doc_id, seq, n_tokens, tokens) of the slots from `first_slot` on, up to `last_slot`.

    Only shards that hold some of them are read; each file is read in one piece.
    """
    if not layout.n:
        return spark.createDataFrame([], ", ".join(_FIELDS))
    last = layout.n - 1 if last_slot is None else last_slot
    files = spark.read.format("binaryFile").load(path).select("shard", "content").where(
        F.col("shard").between(first_slot // layout.per_shard, last // layout.per_shard)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content").to_pylist()):
                raw = np.frombuffer(content, dtype=np.uint8)[: len(content) // layout.stride * layout.stride].reshape(-1, layout.stride)
                for at in range(0, len(raw), 4096):
                    part = raw[at : at + 4096]
                    head = np.ascontiguousarray(part[:, : HEADER.itemsize]).view(HEADER).ravel()
                    keep = (head["slot"] >= first_slot) & (head["slot"] <= last)
                    body = [
                        r[: n * layout.width].tobytes() for r, n in zip(part[keep][:, HEADER.itemsize :], head["n_tokens"][keep])
                    ]
                    head, place = head[keep], (np.arange(at, at + len(part)) * layout.stride)[keep]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(head["slot"]), pa.array(np.full(len(head), shard, dtype=np.int32)), pa.array(place),
                        pa.array(head["doc_id"], mask=head["no_id"] == 1), pa.array(head["seq"]), pa.array(head["n_tokens"]), pa.array(body, pa.binary()),
                    ], [f.split()[0] for f in _FIELDS])

    return files.mapInArrow(run, ", ".join(_FIELDS))


_FIELDS = ["slot long", "shard int", "byte_offset long", "doc_id long", "seq int", "n_tokens int", "tokens binary"]


def digests(sequences: DataFrame) -> DataFrame:
    """The sequences with a checksum in place of their ids."""
    return sequences.select("slot", "shard", "byte_offset", "doc_id", "seq", "n_tokens", F.crc32("tokens").alias("tokens_crc32"))
