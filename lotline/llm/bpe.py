"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

The vocabulary is a rank file (base64 token and rank per line), read from a path that every executor
can reach and never copied. Each match of the pattern is merged by itself and no special token is
recognised. Token boundaries are kept as byte offsets, which follow from the token lengths; the
byte-to-character map turns them into character spans, also where a token ends inside a character.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from lotline.llm.common import id_and_text, small_batches

RANKS = "byte_bpe_50k.tiktoken"
# texts are handed to the library in pieces of about this many characters, cut where matches end anyway
PIECE = 1 << 18
_CUT = re.compile(r"(?<=\S) (?=\S)")
# the pattern with the white space of Unicode, as the rank files mean it; re-based classes take in a few controls more
_MATCH = regex.compile(public_tokenizers.PATTERN.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
# distinct matches in one of the two generations that a worker remembers
REMEMBERED = 300_000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    moved = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(moved)) for b in range(256)]


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> list[bytes]:
    """Token bytes by id."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * (max(int(rank) for _, rank in pairs) + 1)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


@lru_cache(maxsize=2)
def _lengths(path: str) -> np.ndarray:
    return np.array([len(t) for t in _vocabulary(path)], dtype=np.int64)


def _merges(tokens: list[bytes]) -> list[tuple[bytes, bytes]]:
    """The pair that each token of two or more bytes is merged from: what lower ranks alone make of it."""
    ranks = {t: i for i, t in enumerate(tokens) if t}
    merges = []
    for token, rank in ranks.items():
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            known = [(ranks.get(a + b, rank), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            least, at = min(known)
            if least >= rank:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if len(parts) == 2:
            merges.append((parts[0], parts[1]))
    return merges


@lru_cache(maxsize=2)
def tokenizer(path: str):
    """A tokenizer of the tokenizers library from a rank file; one per worker process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    tokens, face = _vocabulary(path), byte_alphabet()
    shown = {t: "".join(face[b] for b in t) for t in tokens if t}
    model = models.BPE(
        vocab={s: i for i, s in enumerate(shown[t] if t else f"\0{i}" for i, t in enumerate(tokens))},
        merges=[(shown[a], shown[b]) for a, b in _merges(tokens)],
    )
    out = Tokenizer(model)
    out.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(public_tokenizers.PATTERN), "isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
    ])
    return out


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """A long text cut before single spaces between words, where the pattern always ends a match."""
    start = 0
    while len(text) - start > size:
        cut = _CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


class Encoder:
    """Ids of texts; the library sees each distinct match of the pattern once while it is remembered.

    Two generations bound the memory: once the young one is full it becomes the old one, and matches still in use
    move on from there, so frequent ones stay. What is remembered depends on the path alone, so an encoder lives as
    long as its worker process.
    """

    def __init__(self, path: str, room: int = REMEMBERED):
        self.path, self.room, self.known, self.old = path, room, {}, {}

    def __call__(self, texts: list[str]) -> list[list[int]]:
        out: list[list[int]] = []
        for text in texts:
            ids: list[int] = []
            for piece in pieces(text):
                matches = _MATCH.findall(piece)
                self._learn(matches)
                for found in map(self.known.__getitem__, matches):
                    ids += found
            out.append(ids)
        return out

    def _learn(self, matches: list[str]) -> None:
        wanted = set(matches)
        new = [m for m in wanted if m not in self.known]
        if self.known and len(self.known) + len(new) > self.room:
            self.known, self.old = {}, self.known
            new = list(wanted)
        kept = self.old.get
        made = []
        for m in new:
            if (ids := kept(m)) is None:
                made.append(m)
            else:
                self.known[m] = ids
        for at in range(0, len(made), 4096):
            part = made[at : at + 4096]
            self.known.update(zip(part, (e.ids for e in tokenizer(self.path).encode_batch_fast(part))))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(texts: list[str], path: str) -> list[list[int]]:
    """Token ids of each text."""
    return encoder(path)(texts)


def decode(ids: list[int], path: str) -> bytes:
    """Bytes of the tokens in a row; a character that was split over tokens is whole again."""
    return b"".join(map(_vocabulary(path).__getitem__, ids))


def char_spans(text: str, ids: list[int], path: str) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) character of each token: the first and one past the last that it has a byte of."""
    ends = np.cumsum(_lengths(path)[np.fromiter(ids, dtype=np.int32, count=len(ids))], dtype=np.int64)
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    char_of = np.cumsum((raw & 0xC0) != 0x80) - 1
    if not len(ends):
        return ends, ends
    starts = np.concatenate(([0], ends[:-1]))
    return char_of[starts], char_of[ends - 1] + 1


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>, starts array<int>, ends array<int>) with the character span of each token.

    Null and empty texts have no tokens. Every row gives one row, repeats included.
    """
    path = path or public_tokenizers.path(RANKS)
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            ids = encode(texts, path)
            spans = [char_spans(t, i, path) for t, i in zip(texts, ids)]
            arrays = [pa.array(x, pa.list_(pa.int32())) for x in (ids, [s for s, _ in spans], [e for _, e in spans])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", "ids", "starts", "ends"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, ids array<int>, starts array<int>, ends array<int>")


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, bytes binary, text string) from token ids; null ids give empty bytes.

    `bytes` is exact. `text` puts U+FFFD where the ids begin or end inside a character.
    """
    path = path or public_tokenizers.path(RANKS)
    small_batches(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [decode(ids or [], path) for ids in batch.column("ids").to_pylist()]
            arrays = [batch.column("doc_id"), pa.array(raw, pa.binary()), pa.array([r.decode(errors="replace") for r in raw])]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "bytes", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary, text string")


def round_trip_digests(docs: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): each text encoded and decoded.

    The digests are of the decimal ids joined by spaces and of the decoded bytes. `with_ids` adds the ids. Null
    texts count as empty; repeated rows give repeated results.
    """
    path = path or public_tokenizers.path(RANKS)
    small_batches(docs.sparkSession)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = [str(i).encode() for i in range(len(_vocabulary(path)))]
        for batch in batches:
            texts = batch.column("text").to_pylist()
            encoded = encode(texts, path)
            lines = [hashlib.sha256(b" ".join(map(name.__getitem__, ids))).hexdigest() for ids in encoded]
            raw = [hashlib.sha256(decode(ids, path)).hexdigest() for ids in encoded]
            arrays = [
                batch.column("doc_id"), pa.array([len(ids) for ids in encoded], pa.int64()), pa.array(lines, pa.string()),
                pa.array(raw, pa.string()), *([pa.array(encoded, pa.list_(pa.int32()))] * with_ids),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names)

    kinds = ["long", "long", "string", "string", "array<int>"]
    return id_and_text(docs).mapInArrow(run, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))
