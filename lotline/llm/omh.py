"""Document fingerprints by order MinHash, sensitive to edit distance.

A text is a row of tokens: its words, long words in pieces. Every k-mer of tokens is numbered by
its occurrence, so repeats differ. For each of `SIZE` hash functions the `ELL` k-mers with the smallest hashes are
taken and, in the order of the text, hashed to one number. Two texts agree in a number if they share those k-mers
in the same order, so moved or repeated passages lower the likeness as edits do.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotline.llm.common import id_and_text, small_batches, text_bytes

SIZE = 64
ELL = 2
K = 2
TOKEN_BYTES = 16
# k-mers hashed at a time under all functions
CHUNK = 1 << 13
# bytes of text that one task pairs up and hashes
PART_BYTES = 8 << 20
CELLS = 256
MAX_PARTS = 100_000
_RNG = np.random.default_rng(20)
_BYTE = _RNG.integers(1, 2**62, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_POWER = np.cumprod(np.full(TOKEN_BYTES + 4, 0x9E3779B97F4A7C15, dtype=np.uint64))
_SEEDS = (_RNG.integers(1, 2**31, (SIZE, 2)) * 2 + 1).astype(np.uint32)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_ONE = np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the output."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def token_hashes(text: bytes) -> np.ndarray:
    """A hash per token of a UTF-8 text: runs without ASCII white space, cut every `TOKEN_BYTES` bytes."""
    raw = np.frombuffer(text, dtype=np.uint8)
    word = ~_BLANK[raw]
    first = word.copy()
    first[1:] &= ~word[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    at = np.arange(len(raw)) - starts[np.maximum(np.cumsum(first) - 1, 0)]
    inside = at % TOKEN_BYTES
    cut = word & (inside == 0)
    cut[: starts[0]] = False
    value = np.where(word, _BYTE[raw] * _POWER[inside], np.uint64(0))
    value[: starts[0]] = 0
    return _mix(np.add.reduceat(value, np.flatnonzero(cut)))


def kmers(tokens: np.ndarray, k: int = K) -> np.ndarray:
    """Hashes of the k-mers in text order, each mixed with the number of its occurrence. Fewer tokens: one k-mer of all."""
    if not len(tokens):
        return tokens
    width = min(k, len(tokens))
    n = len(tokens) - width + 1
    out = np.zeros(n, dtype=np.uint64)
    for j in range(width):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + tokens[j : j + n])
    order = np.argsort(out, kind="stable")
    ranked = out[order]
    run = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    nth = np.arange(n) - np.repeat(run, np.diff(np.append(run, n)))
    out[order] = _mix(ranked + nth.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return out


def _smallest(grams: np.ndarray, offset: int, ell: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of the `ell` k-mers with the smallest hashes under each function; ties go to the earlier one."""
    hashed = (grams[None, :] ^ _SEEDS[:, :1]) * _SEEDS[:, 1:]
    row, values, places = np.arange(SIZE), [], []
    for _ in range(min(ell, len(grams))):
        at = hashed.argmin(axis=1)
        values.append(hashed[row, at])
        places.append(at + offset)
        hashed[row, at] = 0xFFFFFFFF
    return np.stack(values, axis=1), np.stack(places, axis=1)


def signature(text: bytes) -> np.ndarray:
    """`SIZE` numbers of 32 bits. A text without a token has all of them zero; a single k-mer stands for itself."""
    grams = kmers(token_hashes(text))
    if not len(grams):
        return np.zeros(SIZE, dtype=np.uint32)
    ell = min(ELL, len(grams))
    short = (grams >> np.uint64(32)).astype(np.uint32)
    found = [_smallest(short[at : at + CHUNK], at, ell) for at in range(0, len(short), CHUNK)]
    values, places = (np.concatenate(x, axis=1) for x in zip(*found))
    if len(found) > 1:
        best = np.lexsort((places, values), axis=1)[:, :ell]
        places = np.take_along_axis(places, best, axis=1)
    chosen = np.sort(places, axis=1)
    out = np.zeros(SIZE, dtype=np.uint64)
    for j in range(ell):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + grams[chosen[:, j]] + _ONE)
    return (out >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the numbers in which two signatures agree."""
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """The text with its last floor(n/2) characters replaced by the first as many (or all) of another."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint_text(sign: np.ndarray) -> str:
    return sign.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint), one row per document; null texts count as empty."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            prints = pa.array([fingerprint_text(signature(t)) for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), prints], ["doc_id", "fingerprint"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, fingerprint string")


def _parts(texts: DataFrame, n_parts: int) -> Column:
    """Number of the id range that a row lies in, larger ids first, of about `n_parts` ranges with like many rows.

    Up to `CELLS` ranges are cut at approximate quantiles; beyond, each is cut again at even steps. Null ids are in the last.
    """
    cells = min(n_parts, CELLS)
    inner = -(-n_parts // cells)
    steps = [i / cells for i in range(cells + 1)]
    cuts = texts.agg(F.percentile_approx("doc_id", steps, 10_000).alias("cuts")).head()["cuts"] or [0, 0]
    bounds = F.array(*[F.lit(c) for c in cuts])
    cell = F.least(F.greatest(F.aggregate(bounds, F.lit(-1), lambda n, c: n + (F.col("doc_id") >= c).cast("int")), F.lit(0)), F.lit(len(cuts) - 2))
    low, high = F.get(bounds, cell).cast("double"), F.get(bounds, cell + 1).cast("double")
    step = F.when(high > low, F.floor((F.col("doc_id") - low) / (high - low) * inner)).otherwise(0)
    ascending = cell * inner + F.least(F.greatest(step, F.lit(0)), F.lit(inner - 1)).cast("int")
    return F.coalesce(F.lit((len(cuts) - 1) * inner) - ascending, F.lit((len(cuts) - 1) * inner + 1)).cast("int")


def with_following(docs: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """(part, doc_id, text, mark, tail): rows by ranges of ids, each with a copy, marked `tail`, of the row that follows its last.

    Ids go down; null ids come last, and rows that repeat an id are ordered by a hash of their text. After the last row of
    all the first follows. The text is shuffled once. The table of first rows has a row per range, `MAX_PARTS` at most,
    and is broadcast for that.
    """
    texts = id_and_text(docs).withColumn("mark", F.xxhash64("text"))
    n_parts = min(MAX_PARTS, max(1, -(-text_bytes(docs) // part_bytes)))
    placed = texts.withColumn("part", _parts(texts, n_parts))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), (-F.col("doc_id")).alias("down"), "mark"))
    heads = placed.groupBy("part").agg(first.alias("first")).collect()
    order = sorted(r["part"] for r in heads)
    before = dict(zip(order, order[-1:] + order[:-1]))
    rows = [(None if r["first"]["none"] else -r["first"]["down"], r["first"]["mark"], before[r["part"]]) for r in heads]
    known = docs.sparkSession.createDataFrame(rows, "head_id long, head_mark long, tail_part int")
    joined = placed.join(
        F.broadcast(known), F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("mark") == F.col("head_mark")), "left"
    )
    own = F.struct(F.col("part"), F.lit(False).alias("tail"))
    copy = F.struct(F.col("tail_part").alias("part"), F.lit(True).alias("tail"))
    copies = F.when(F.col("tail_part").isNull(), F.array(own)).otherwise(F.array(own, copy))
    return (
        joined.select("doc_id", "text", "mark", F.inline(copies))
        .repartition(max(1, len(order)), "part")
        .sortWithinPartitions("part", "tail", F.col("doc_id").desc_nulls_last(), "mark")
    )


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(doc_id, text, next text) in order; of repeated tails the first counts."""
    last = None
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("part", "doc_id", "text", "tail"))
        for part, doc_id, text, tail in zip(*columns):
            if last is not None and last[0] == part:
                yield last[1], last[2], text
            last = None if tail else (part, doc_id, text)


def compare_with_edits(docs: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), one row per document.

    The edited text has its last floor(n/2) characters replaced by the first as many (or all) of the next document.
    near_edited and near_next are the likeness of the document's fingerprint to those of its edited text and of the next
    document. Null texts count as empty; an empty text equals its edited text. A lone document follows itself.
    Texts without a token have fingerprint zero and are alike. Repeated rows each give a row.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        known: tuple = (None, None)
        for doc_id, text, following in _pairs(batches):
            own = known[1] if known[0] is text else signature(text.encode())
            after = signature(following.encode())
            known = (following, after)
            changed = edited(text, following)
            raw = changed.encode()
            new = signature(raw)
            rows.append((
                doc_id, len(text), hashlib.sha256(raw).hexdigest(), fingerprint_text(own), fingerprint_text(new),
                likeness(own, new), likeness(own, after),
            ))
            if len(rows) >= 256:
                yield _rows_out(rows)
                rows = []
        yield _rows_out(rows)

    return with_following(docs, part_bytes).select("part", "doc_id", "text", "tail").mapInArrow(run, ", ".join(f"{n} {k}" for n, k, _ in _OUT))


_OUT = [
    ("doc_id", "long", pa.int64()), ("n_chars", "long", pa.int64()), ("edited_sha256", "string", pa.string()), ("fingerprint", "string", pa.string()),
    ("edited_fingerprint", "string", pa.string()), ("near_edited", "double", pa.float64()), ("near_next", "double", pa.float64()),
]


def _rows_out(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(_OUT)
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, _, kind) in zip(columns, _OUT)], [n for n, _, _ in _OUT])
