"""Secrets in texts: fixed patterns, and a linear-chain conditional random field for what the patterns do not know.

Tokens are tagged as begin, inside or outside of a secret. A tag's score comes from the token's shape, characters and
length, from the words and shapes of the three tokens before and of the one after, and from features of the
whole file; a learned table scores a tag after a tag, and Viterbi finds the best tags. Weights are learned from
windows of tokens around what the fixed patterns find and from windows of other texts.

Everything about a token that does not depend on its place is worked out once and remembered, so a text costs
a look-up per token. Tags between two tokens that are outside for certain are found by themselves, which is exact.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline.llm.common import drawn, id_and_text, small_batches
from lotline.staging import stage

# fixed values: the base patterns; ASCII letters only are taken in either case
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
METHOD_KIND = "tagged"
# a text that holds a base match holds one of these, case apart for the first
_HINT = rf"(?i:{ASSIGN})|AKIA[A-Z0-9]{{{MIN_ACCESS - 4}}}|[0-9a-f]{{{MIN_HEX}}}"

_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
# a failing match of these two takes nothing from a later one, so the least length goes into the pattern
_ACCESS = re.compile(r"AKIA[A-Z0-9]{%d,}" % (MIN_ACCESS - 4))
_HEX = re.compile(r"[0-9a-f]{%d,}" % MIN_HEX)

_SIGNS = r"""\s"'`=:;,!?#$%&*|~^<>()\[\]{}\\"""
_TOKEN = re.compile(rf"[^{_SIGNS}.]+(?:\.+[^{_SIGNS}.]+)*|[^\s]")
BEGIN, INSIDE, OUTSIDE = 0, 1, 2
# tokens whose words and shapes a tag sees besides its own, by distance
NEIGHBOURS = (-3, -2, -1, 1)
BUCKETS = 1 << 15
# bounds of what the weights are learned from: windows with a base match, windows without, tokens in one
FIT_SECRETS, FIT_OTHERS, WINDOW = 4_000, 6_000, 48
ROUNDS, EPOCHS, PARTS, BATCH, RATE, DECAY = 4, 2, 6, 64, 0.05, 1e-5
# share of the training windows that are shown without the tokens' own features, and as many without the neighbours'
HIDE = 0.2
PIECE = 1 << 20
REMEMBERED = 250_000
SHORT = 1 << 15
_NO_TOKEN = ""


def base_spans(text: str) -> list[tuple[str, int, int, int]]:
    """(kind, start, end, start of the value) of every base match, by start, then kind."""
    out = [("assign", m.start(), m.end(), m.start(2)) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    out += [("access", *m.span(), m.start()) for m in _ACCESS.finditer(text)]
    out += [("hex", *m.span(), m.start()) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def _step(x: float, *limits: float) -> int:
    """How many of the rising limits x is above."""
    return bisect_left(limits, x)


# kinds of UTF-8 bytes: lower, upper, digit, beyond ASCII; signs stand for themselves
_KIND = np.arange(256, dtype=np.uint8)
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 97, 65, 48, 128
_VOWEL = np.isin(np.arange(256), [ord(c) for c in "aeiouAEIOU"])
_HEX_SIGN = np.isin(np.arange(256), [ord(c) for c in "0123456789abcdefABCDEF"])
_MIX = np.random.default_rng(7).integers(1, 2**63, 256).astype(np.uint64) | np.uint64(1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(SHAPE_RUNS := 10, _ODD))
_LENGTHS, _SHARES, _VOWELS, _KINDS, _RUNS = ([1, 2, 3, 5, 7, 9, 11, 15, 19, 23, 31, 39, 63], [0, 0.1, 0.3, 0.6, 0.9], [0.05, 0.15, 0.3, 0.45], [0.3, 0.5, 0.7, 0.9], [1, 2, 3, 5, 8])
_NO_FEATURE = 0
OWN, NEAR = 12, 5
_LONGEST = 256  # bytes of a token that its features see


def token_features(tokens: list[str]) -> np.ndarray:
    """Hashes of what each token says about itself (the first `OWN`) and of what it says to its neighbours (`NEAR`).

    About itself: shape (runs of lower, upper, digit and other letters as one sign each), length, shares of digits and capitals, runs,
    distinct bytes, vowels, hex digits or not, first and last letters. To neighbours: word, shape, last and first letters, length.
    """
    known = [t for t in tokens if t != _NO_TOKEN]
    raw = [t.encode()[:_LONGEST] for t in known]
    low = [t.lower().strip("._-/+").encode()[:24] for t in known]
    sizes = np.array([len(r) for r in raw], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    byte = np.frombuffer(b"".join(raw), dtype=np.uint8)
    kind, owner = _KIND[byte], np.repeat(np.arange(len(raw)), sizes)
    change = np.append(True, kind[1:] != kind[:-1]) if len(kind) else np.zeros(0, dtype=bool)
    change[starts] = True
    runs = np.bincount(owner, weights=change, minlength=len(raw)).astype(np.int64)
    at = np.flatnonzero(change)
    place = np.arange(len(at)) - np.repeat(np.cumsum(runs) - runs, runs)
    sign = np.where(place < SHAPE_RUNS, _MIX[kind[at]] * _POWERS[np.minimum(place, SHAPE_RUNS - 1)], np.uint64(0))
    shape = np.add.reduceat(sign, np.cumsum(runs) - runs) if len(raw) else np.zeros(0, dtype=np.uint64)
    distinct = np.bincount(np.unique(owner * 256 + byte) // 256, minlength=len(raw))

    def share(of: np.ndarray, limits: list[float]) -> np.ndarray:
        return np.searchsorted(limits, np.bincount(owner, weights=of, minlength=len(raw)) / np.maximum(sizes, 1))

    def letters(words: list[bytes], width: int) -> np.ndarray:
        return (np.array(words, dtype=f"S{width}").view(np.uint8).reshape(len(words), width) if words else np.zeros((0, width), np.uint8))

    def joined(table: np.ndarray) -> np.ndarray:
        out = np.zeros(len(table), dtype=np.uint64)
        for column in table.T:
            out = (out + column + np.uint64(1)) * _ODD
        return out

    length = np.searchsorted(_LENGTHS, sizes)
    mix = share(kind == 48, _SHARES) * 8 + share(kind == 65, _SHARES)
    head, word = letters(raw, 4), letters(low, 24)
    tail = letters([w[:-6:-1] for w in low], 5)
    parts = [
        shape, length, mix, np.searchsorted(_RUNS, runs), length * 64 + mix, np.searchsorted(_KINDS, distinct / np.maximum(sizes, 1)) * 16 + length,
        share(_VOWEL[byte], _VOWELS) * 16 + length, share(~_HEX_SIGN[byte], [0]) * 16 + length, joined(word[:, :3]), joined(tail[:, :3]), joined(head),
        np.zeros(len(raw)), joined(word), shape, joined(tail), joined(word[:, :4]), length,
    ]
    out = np.empty((len(tokens), OWN + NEAR), dtype=np.uint64)
    rows = np.fromiter((t != _NO_TOKEN for t in tokens), dtype=bool, count=len(tokens))
    for k, part in enumerate(parts):
        number = np.uint64(k if k < OWN else 64 + k)
        out[rows, k] = ((part.astype(np.uint64) * _ODD + number + np.uint64(1)) * _MIX[number]) | np.uint64(1)
        out[~rows, k] = _MIX[number] if k in (0, OWN) else _NO_FEATURE
    return out


def file_features(text: str) -> list[int]:
    """Hashes of what the whole file looks like: signs of code, quotes, length of its lines, size."""
    n = max(1, len(text))
    signs = sum(map(text.count, "={}()[];<>_")) / n
    parts = [f"signs {_step(signs, 0, 0.002, 0.01, 0.05)}", f"quotes {_step(text.count(chr(34)) / n, 0, 0.001, 0.01)}",
             f"lines {_step(n / (text.count(chr(10)) + 1), 20, 60, 200, 1000)}", f"size {_step(n, 50, 200, 1000, 5000, 50000)}"]
    return [zlib.crc32(f"file {p}".encode()) for p in parts]


def _slots(hashes: np.ndarray, role: int) -> np.ndarray:
    """Places of features in the weights: the same feature has another place in another role; no feature has the last."""
    mixed = (hashes.astype(np.uint64) + np.uint64(1 + role)) * _ODD
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _ODD
    return np.where(hashes == _NO_FEATURE, BUCKETS, mixed >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int32)


class Weights(NamedTuple):
    """Scores of the three tags by feature place (zero at the last, which stands for none), and of a tag (column) after a tag (row)."""

    feature: np.ndarray
    follow: np.ndarray


def no_weights() -> Weights:
    """Weights that tag every token as outside."""
    feature = np.zeros((BUCKETS + 1, 3), dtype=np.float32)
    feature[_slots(token_features(["any"])[0, OWN - 1 : OWN], 0), OUTSIDE] = 1
    return Weights(feature, np.zeros((3, 3), dtype=np.float32))


class Scorer:
    """Emission scores of tokens: what a token adds to its own tags and to those of its neighbours, remembered.

    Two generations bound the memory: once the young one is full it becomes the old one, and what is still in use
    moves on from there.
    """

    def __init__(self, weights: Weights, room: int = REMEMBERED):
        self.weights, self.room = weights, room
        self.old, self.young = {}, {}
        self.old_rows, self.rows = (np.empty((0, 1 + len(NEIGHBOURS), 3), dtype=np.float32) for _ in range(2))

    def learn(self, tokens: set[str]) -> None:
        """Work out and keep what is not known yet of these tokens."""
        new = [t for t in tokens if t not in self.young]
        if self.young and len(self.young) + len(new) > self.room:
            self.old, self.old_rows, self.young, self.rows = self.young, self.rows, {}, np.empty_like(self.rows)
            new = list(tokens)
        n = len(self.young)
        if n + len(new) > len(self.rows):
            more = np.empty((max(2 * len(self.rows), n + len(new), 4096), *self.rows.shape[1:]), dtype=np.float32)
            more[:n] = self.rows[:n]
            self.rows = more
        made = []
        for t in new:
            if (at := self.old.get(t)) is None:
                made.append(t)
            else:
                self.rows[n] = self.old_rows[at]
                self.young[t], n = n, n + 1
        for at in range(0, len(made), 8192):
            part = made[at : at + 8192]
            self.rows[n : n + len(part)] = self._score(part)
            self.young.update(zip(part, range(n, n + len(part))))
            n += len(part)

    def _score(self, tokens: list[str]) -> np.ndarray:
        features = token_features(tokens)
        parts = [features[:, :OWN], *[features[:, OWN:]] * len(NEIGHBOURS)]
        return np.stack([self.weights.feature[_slots(p, role)].sum(axis=1) for role, p in enumerate(parts)], axis=1)

    def rows_of(self, tokens: list[str], learned: bool = False) -> np.ndarray:
        """(tokens, roles, tags) for the tokens in a row; `learned` if nothing else was learned since they were."""
        if not learned:
            self.learn(set(tokens))
        return self.rows[np.fromiter(map(self.young.__getitem__, tokens), dtype=np.int64, count=len(tokens))]

    def file(self, text: str) -> np.ndarray:
        return self.weights.feature[_slots(np.array(file_features(text)), 1 + len(NEIGHBOURS))].sum(axis=0)


def emissions(rows: np.ndarray, file: np.ndarray) -> np.ndarray:
    """Scores of the tags of all tokens but the first three and the last, which are only neighbours."""
    n = len(rows) - 4
    out = rows[3 : 3 + n, 0] + file
    for role, away in enumerate(NEIGHBOURS, 1):
        out += rows[3 + away : 3 + away + n, role]
    return out


def viterbi(scores: np.ndarray, follow: np.ndarray, before: int | None = None, after: int | None = None) -> np.ndarray:
    """The best tags of a row of tokens, between two known tags if these are given; ties go to the lower tag number."""
    now = scores[0] + (follow[before] if before is not None else 0)
    back = np.empty((len(scores), 3), dtype=np.int8)
    for t in range(1, len(scores)):
        paths = now[:, None] + follow
        back[t] = paths.argmax(axis=0)
        now = paths.max(axis=0) + scores[t]
    if after is not None:
        now = now + follow[:, after]
    tags = np.empty(len(scores), dtype=np.int8)
    tags[-1] = now.argmax()
    for t in range(len(scores) - 1, 0, -1):
        tags[t - 1] = back[t][tags[t]]
    return tags


def certainly_outside(scores: np.ndarray, follow: np.ndarray) -> np.ndarray:
    """Tokens whose tag is outside on every best path: no change of the two transitions outweighs the lead."""
    return scores[:, OUTSIDE] - scores[:, :OUTSIDE].max(axis=1) > 2 * (follow.max() - follow.min()) + 1e-3


def best_tags(scores: np.ndarray, follow: np.ndarray) -> np.ndarray:
    """The tags that Viterbi gives, worked out for each run of tokens between two that are certainly outside."""
    tags = np.full(len(scores), OUTSIDE, dtype=np.int8)
    open_ = np.flatnonzero(~certainly_outside(scores, follow))
    if not len(open_):
        return tags
    for run in np.split(open_, np.flatnonzero(np.diff(open_) > 1) + 1):
        start, end = run[0], run[-1] + 1
        tags[start:end] = viterbi(scores[start:end], follow, OUTSIDE if start else None, OUTSIDE if end < len(scores) else None)
    return tags


def _pieces(text: str, size: int) -> Iterator[tuple[int, int]]:
    """Bounds of pieces of about `size` characters, cut at white space, which no token holds."""
    start = 0
    while len(text) - start > size:
        cut = _BLANK.search(text, start + size)
        if cut is None:
            break
        yield start, cut.start()
        start = cut.start()
    yield start, len(text)


_BLANK = re.compile(r"\s")


def spans_of_learned(text: str, tokens: list[str], scorer: Scorer) -> list[tuple[int, int]]:
    """`tagged_spans` of a text whose tokens, and the missing one, the scorer has just learned."""
    rows = scorer.rows_of([_NO_TOKEN] * 3 + tokens + [_NO_TOKEN], learned=True)
    tags = best_tags(emissions(rows, scorer.file(text)), scorer.weights.follow)
    return _spans(text, [(0, len(text), len(tokens))], tags)


def tagged_spans(text: str, scorer: Scorer, piece: int = PIECE) -> list[tuple[int, int]]:
    """(start, end) of what the field tags as secret; an inside tag after an outside one begins a span as well.

    A very long text is tokenised and scored piece by piece; scores wait until a token that is certainly outside
    ends the run, so the tags are those of the whole text.
    """
    file, follow = scorer.file(text), scorer.weights.follow
    spans: list[tuple[int, int]] = []
    waiting, scores = [], np.zeros((0, 3), dtype=np.float32)  # pieces as (start, end, first token, tokens), and the scores of their tokens
    rows = scorer.rows_of([_NO_TOKEN] * 3)
    bounds = list(_pieces(text, piece))
    for k, (start, end) in enumerate(bounds):
        tokens = _TOKEN.findall(text, start, end)
        last = k + 1 == len(bounds)
        rows = np.concatenate((rows, scorer.rows_of(tokens + [_NO_TOKEN] * last)))
        waiting.append((start, end, len(tokens)))
        if len(rows) > 4:
            scores = np.concatenate((scores, emissions(rows, file)))
            rows = rows[-4:]
        done = len(scores)
        if not last:
            # the last token that is certainly outside stays, as the one before the rest
            sure = np.flatnonzero(certainly_outside(scores, follow))
            done = sure[-1] if len(sure) else 0
        if done:
            spans += _spans(text, waiting, best_tags(scores[: done + (not last)], follow)[:done])
            waiting, scores = _rest(text, waiting, done), scores[done:]
    return spans


def _rest(text: str, pieces: list[tuple[int, int, int]], done: int) -> list[tuple[int, int, int]]:
    """The pieces without their first `done` tokens."""
    for k, (start, end, n) in enumerate(pieces):
        if done < n:
            first = next(islice(_TOKEN.finditer(text, start, end), done, None))
            return [(first.start(), end, n - done), *pieces[k + 1 :]]
        done -= n
    return []


def _spans(text: str, pieces: list[tuple[int, int, int]], tags: np.ndarray) -> list[tuple[int, int]]:
    """Tagged tokens of the pieces as spans of the text, the tokens of a span joined."""
    out: list[list[int]] = []
    at = 0
    joins = False
    for start, end, n in pieces:
        own = tags[at : at + n]
        at += n
        if not (own != OUTSIDE).any():
            joins = False
            continue
        for tag, m in zip(own, _TOKEN.finditer(text, start, end)):
            if tag == INSIDE and joins:
                out[-1][1] = m.end()
            elif tag != OUTSIDE:
                out.append([*m.span()])
            joins = tag != OUTSIDE
    return [(a, b) for a, b in out]


def _training_windows(text: str, secret: bool, draw: int) -> Iterator[tuple[list[str], bytes]]:
    """Windows of tokens with three neighbours before and one after, and their tags by the base matches.

    A text with base matches gives a window around each of its first and last few; another text gives one, at a drawn place.
    """
    found = [(value, end) for _, _, end, value in base_spans(text)]
    if secret != bool(found):
        return
    matches = list(_TOKEN.finditer(text))
    if not matches:
        return
    tokens = [_NO_TOKEN] * 3 + [m.group() for m in matches] + [_NO_TOKEN]
    starts, ends = (np.array([f(m) for m in matches]) for f in (lambda m: m.start(), lambda m: m.end()))
    tags = np.full(len(matches), OUTSIDE, dtype=np.int8)
    places = []
    for value, end in found:
        first, past = np.searchsorted(ends, value, side="right"), np.searchsorted(starts, end)
        if first < past and tags[first] == OUTSIDE:
            tags[first], tags[first + 1 : past] = BEGIN, INSIDE
            places.append(first)
    if not secret:
        places = [draw % len(matches)]
    for place in {*places[:4], *places[-4:]}:
        at = max(0, min(place - WINDOW // 2, len(matches) - WINDOW))
        yield tokens[at : at + WINDOW + 4], tags[at : at + WINDOW].tobytes()


def windows(docs: DataFrame, secrets: int = FIT_SECRETS, others: int = FIT_OTHERS) -> DataFrame:
    """(part, secret, tokens, tags, file) of a bounded sample: at most so many windows with and without a base match.

    All texts are searched; which windows stay goes by a hash of id and place, so the sample is even over the table.
    """
    small_batches(docs.sparkSession)
    texts = id_and_text(docs)
    n = texts.count()
    chosen = drawn(F.xxhash64("doc_id", F.lit("other")), 2 * others, n)
    picked = texts.withColumn("secret", F.col("text").rlike(_HINT)).where(F.col("secret") | chosen).withColumn("draw", F.abs(F.hash("doc_id", F.lit("place")).cast("long")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in ("doc_id", "text", "secret", "draw")}
            rows = [
                (doc_id, secret, tokens, tags, file_features(text))
                for doc_id, text, secret, draw in zip(*columns.values()) for tokens, tags in _training_windows(text, secret, draw)
            ]
            kinds = [pa.int64(), pa.bool_(), pa.list_(pa.string()), pa.binary(), pa.list_(pa.int64())]
            names = ["doc_id", "secret", "tokens", "tags", "file"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    schema = "doc_id long, secret boolean, tokens array<string>, tags binary, file array<long>"
    found = stage(picked.mapInArrow(cut, schema), "windows").withColumn("order", F.xxhash64("doc_id", "tokens", "tags"))
    some = [found.where("secret").orderBy("order", "doc_id").limit(secrets), found.where("not secret").orderBy("order", "doc_id").limit(others)]
    dealt = some[0].unionByName(some[1]).withColumn("part", F.pmod("order", F.lit(PARTS)).cast("int")).drop("doc_id")
    return stage(dealt.repartition(PARTS, "part"), "sample")


def _features(tokens: list[list[str]], files: list[list[int]], rng: np.random.Generator) -> np.ndarray:
    """(windows, WINDOW, features): places of the features of every token; some windows go without those of one side."""
    known = sorted({t for row in tokens for t in row} | {_NO_TOKEN})
    number = {t: i for i, t in enumerate(known)}
    table = token_features(known)
    at = np.full((len(tokens), WINDOW + 4), number[_NO_TOKEN])
    for w, row in enumerate(tokens):
        at[w, : len(row)] = [number[t] for t in row]
    middle = np.arange(3, 3 + WINDOW)
    parts = [_slots(table[at[:, middle]][:, :, :OWN], 0)]
    parts += [_slots(table[at[:, middle + away]][:, :, OWN:], role) for role, away in enumerate(NEIGHBOURS, 1)]
    ending = _slots(np.array(files, dtype=np.uint64), 1 + len(NEIGHBOURS))
    parts.append(np.repeat(ending[:, None, :], WINDOW, axis=1))
    draw = rng.random(len(tokens))
    parts[0][draw < HIDE] = BUCKETS
    for part in parts[1:-1]:
        part[draw > 1 - HIDE] = BUCKETS
    return np.concatenate(parts, axis=2)


def log_likelihood(scores: np.ndarray, follow: np.ndarray, tags: np.ndarray, sizes: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Summed log-likelihood of tags (windows, length), with its gradients by the scores and by the table of transitions."""
    b, length, _ = scores.shape
    live = np.arange(length) < sizes[:, None]
    forward, backward = np.zeros((b, length, 3)), np.zeros((b, length, 3))
    forward[:, 0] = scores[:, 0]
    for t in range(1, length):
        forward[:, t] = np.where(live[:, t, None], np.logaddexp.reduce(forward[:, t - 1, :, None] + follow, axis=1) + scores[:, t], forward[:, t - 1])
    for t in range(length - 2, -1, -1):
        step = np.logaddexp.reduce(follow + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
        backward[:, t] = np.where(live[:, t + 1, None], step, 0)
    total = np.logaddexp.reduce(forward[:, -1], axis=1)
    share = np.exp(forward + backward - total[:, None, None]) * live[:, :, None]
    own = np.zeros_like(scores)
    np.put_along_axis(own, tags[:, :, None], 1, axis=2)
    own *= live[:, :, None]
    pair = forward[:, :-1, :, None] + follow + (scores + backward)[:, 1:, None, :] - total[:, None, None, None]
    linked = live[:, 1:]
    expected = (np.exp(pair) * linked[:, :, None, None]).sum(axis=(0, 1))
    seen = np.zeros((3, 3))
    np.add.at(seen, (tags[:, :-1][linked], tags[:, 1:][linked]), 1)
    value = (scores * own).sum() + (follow * seen).sum() - total.sum()
    return float(value), own - share, seen - expected


def _local_steps(flat: bytes, seed: int):
    """The steps that one part of the windows takes from shared weights."""

    def local(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("order")
        rng = np.random.default_rng(seed)
        places = _features([list(t) for t in part["tokens"]], [list(f) for f in part["file"]], rng)
        sizes = np.array([len(t) for t in part["tags"]])
        tags = np.zeros((len(part), WINDOW), dtype=np.int64)
        for i, t in enumerate(part["tags"]):
            tags[i, : len(t)] = np.frombuffer(t, dtype=np.int8)
        found = _take_steps(_unpack(flat), places, tags, sizes, rng)
        return pd.DataFrame({"part": part["part"].iloc[:1], "n": [len(part)], "flat": [_pack(found)]})

    return local


def _take_steps(weights: Weights, places: np.ndarray, tags: np.ndarray, sizes: np.ndarray, rng: np.random.Generator) -> Weights:
    """A few epochs of Adam over mini-batches of windows."""
    both = [x.astype(np.float64) for x in weights]
    m, v, n = [np.zeros_like(x) for x in both], [np.zeros_like(x) for x in both], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(places))
        for at in range(0, len(order), BATCH):
            part = order[at : at + BATCH]
            at_, n = places[part], n + 1
            scores = both[0][at_].sum(axis=2)
            _, by_score, by_follow = log_likelihood(scores, both[1], tags[part], sizes[part])
            wide = np.repeat(by_score.reshape(-1, 1, 3), at_.shape[2], axis=1).reshape(-1, 3)
            by_feature = np.column_stack([np.bincount(at_.ravel(), weights=wide[:, k], minlength=BUCKETS + 1) for k in range(3)])
            by_feature[BUCKETS] = 0
            for k, g in enumerate((by_feature, by_follow)):
                g = -g / len(part) + DECAY * both[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                both[k] -= RATE * (m[k] / (1 - 0.9**n)) / (np.sqrt(v[k] / (1 - 0.999**n)) + 1e-8)
    return Weights(*[x.astype(np.float32) for x in both])


def _pack(weights: Weights) -> bytes:
    return np.concatenate((weights.feature.ravel(), weights.follow.ravel())).astype(np.float32).tobytes()


def _unpack(flat: bytes) -> Weights:
    numbers = np.frombuffer(flat, dtype=np.float32)
    return Weights(numbers[:-9].reshape(BUCKETS + 1, 3), numbers[-9:].reshape(3, 3))


def learn(docs: DataFrame, secrets: int = FIT_SECRETS, others: int = FIT_OTHERS, rounds: int = ROUNDS) -> Weights:
    """Weights of the field from a bounded sample of windows, labelled by the base patterns.

    Every round each of `PARTS` tasks starts from the same weights and returns its own, which are averaged.
    Without a window that holds a base match every token is tagged as outside.
    """
    sample = windows(docs, secrets, others)
    if not sample.where("secret").limit(1).count():
        return no_weights()
    flat = _pack(Weights(np.zeros((BUCKETS + 1, 3)), np.zeros((3, 3))))
    for step in range(rounds):
        results = sample.groupBy("part").applyInPandas(_local_steps(flat, step), "part int, n long, flat binary").collect()
        flat = np.average([np.frombuffer(r["flat"], dtype=np.float32) for r in results], axis=0, weights=[r["n"] for r in results]).astype(np.float32).tobytes()
    return _unpack(flat)


@lru_cache(maxsize=1)
def _scorer(flat: bytes) -> Scorer:
    return Scorer(_unpack(flat))


def text_spans(text: str, scorer: Scorer) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all base matches and of the tagged spans that touch none, by start, then kind."""
    return _with_base(text, tagged_spans(text, scorer))


def batch_spans(texts: list[str], scorer: Scorer) -> list[list[tuple[str, int, int]]]:
    """`text_spans` of each text; the tokens of all short ones are learned together."""
    out: list = [None] * len(texts)
    short = {i: _TOKEN.findall(t) for i, t in enumerate(texts) if len(t) < SHORT}
    scorer.learn({_NO_TOKEN}.union(*short.values()))
    for i, tokens in short.items():
        out[i] = _with_base(texts[i], spans_of_learned(texts[i], tokens, scorer))
    for i, text in enumerate(texts):
        if i not in short:
            out[i] = text_spans(text, scorer)
    return out


def _with_base(text: str, tagged: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
    base = [s[:3] for s in base_spans(text)]
    more, k, reach = [], 0, 0
    for start, end in tagged:
        while k < len(base) and base[k][1] < end:
            reach = max(reach, base[k][2])
            k += 1
        if start >= reach:
            more.append((METHOD_KIND, start, end))
    kinds = [*KINDS, METHOD_KIND]
    return sorted(base + more, key=lambda s: (s[1], kinds.index(s[0])))


def find_secrets(docs: DataFrame, weights: Weights) -> DataFrame:
    """(doc_id, spans array<struct<kind, start, end, value>>), one row per document, repeats included.

    Places are code points, ends exclusive. Null and empty texts have no spans; whole texts are read.
    """
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(_pack(weights))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(sent.value)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = zip(texts, batch_spans(texts, scorer))
            out = [[{"kind": k, "start": a, "end": b, "value": text[a:b]} for k, a, b in spans] for text, spans in found]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, kind)], ["doc_id", "spans"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:long,end:long,value:string>>")


def digests(found: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_tagged): counts, the base spans' digest, all spans as kind:start:end."""
    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def line(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    base = F.filter("spans", lambda s: s["kind"] != METHOD_KIND)
    return found.select(
        "doc_id", *[count(k) for k in KINDS], F.sha2(line(base).cast("binary"), 256).alias("base_sha256"),
        line(F.col("spans")).alias("spans"), count(METHOD_KIND),
    )
