"""Language-model scores from a hierarchical Pitman-Yor model, seated by Gibbs sampling over partitions.

Every context (the word before) has a Chinese restaurant in which the words that follow it sit; all context
restaurants share one parent, in which one customer sits for each of their tables; below it lies the uniform
distribution. The seating is summed up by counts of customers c and tables t per word and restaurant.
A sweep reseats all customers of a word in a restaurant given everything else as the last sweep left it;
predictive probabilities are averaged over sweeps.

The work is dealt by context, so a restaurant is whole in one task; contexts that hold a large share of the words are
dealt by word pair. What moves are the distinct pairs of each batch of documents with their counts; the documents' entries
stay together. Each bucket names its words and split contexts to their owners once. In every sweep it sends only their tables,
in the order of the names; the owners reseat the parent and send the sums back, so a sweep knows all restaurants and the
parent as the last one left them, and each sample is one of all restaurants together.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotline.llm.common import fold_of, id_and_text, small_batches, text_bytes

DISCOUNT, STRENGTH = 0.8, 1.0
ROOT_DISCOUNT, ROOT_STRENGTH = 0.7, 5.0
BURN_IN, SAMPLES = 2, 4
SEED = 17
# tokens of a bucket, and tokens that a task holds before it hands them on
BUCKET_BYTES = 20 << 20
HELD_TOKENS = 2_000_000
LEAST_BUCKETS = 1
# an owner has the words and split contexts that a hash gives it, as many as so many buckets have
BUCKETS_PER_OWNER = 8
EXACT = 16


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_RNG = np.random.default_rng(23)
_BYTE = _RNG.integers(1, 2**62, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_POWER = np.cumprod(np.full(4096, 0x9E3779B97F4A7C15, dtype=np.uint64))
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
BEGIN, END = _mix(np.array([1, 2], dtype=np.uint64))


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of a UTF-8 text, A-Z as a-z; words are runs without ASCII white space."""
    raw = np.frombuffer(text, dtype=np.uint8)
    word = ~_BLANK[raw]
    first = word.copy()
    first[1:] &= ~word[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    at = np.arange(len(raw)) - starts[np.maximum(np.cumsum(first) - 1, 0)]
    power = _POWER[at] if at.max() < len(_POWER) else _POWER[at % len(_POWER)] + (at // len(_POWER)).astype(np.uint64)
    return _mix(np.add.reduceat(np.where(word, _BYTE[raw] * power, np.uint64(0)), starts))


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers as one compressed block. Whole numbers take no more bytes than the largest needs, 64-bit ones are
    stored as steps (names come in rising order), and bytes of one place lie together."""
    small = [a.astype(np.min_scalar_type(a.max())) if a.dtype.kind == "i" and len(a) and a.min() >= 0 else a for a in arrays]
    head = json.dumps([(a.dtype.str, len(a)) for a in small]).encode()
    steps = [np.diff(a, prepend=a.dtype.type(0)) if a.dtype == np.uint64 else a for a in small]
    body = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in steps)
    return zstandard.ZstdCompressor(level=3).compress(len(head).to_bytes(4, "little") + head + body)


def unpack(block: bytes) -> list[np.ndarray]:
    raw = zstandard.decompress(block)
    size = int.from_bytes(raw[:4], "little")
    out, at = [], 4 + size
    for kind, n in json.loads(raw[4:at]):
        kind = np.dtype(kind)
        planes = np.frombuffer(raw, dtype=np.uint8, count=n * kind.itemsize, offset=at).reshape(kind.itemsize, n)
        a = np.ascontiguousarray(planes.T).reshape(-1).view(kind)
        out.append(np.cumsum(a, dtype=np.uint64) if kind == np.uint64 else a)
        at += n * kind.itemsize
    return out


def _log_stirling(discount: float) -> np.ndarray:
    """log of the generalised Stirling numbers: ways to seat c customers at t tables, weighted by the discount."""
    out = np.full((EXACT + 1, EXACT + 1), -np.inf)
    out[0, 0] = 0
    for c in range(1, EXACT + 1):
        for t in range(1, c + 1):
            stay = out[c - 1, t] + np.log(c - 1 - discount * t) if c - 1 - discount * t > 0 else -np.inf
            out[c, t] = np.logaddexp(out[c - 1, t - 1], stay)
    return out


def _hazard(x: np.ndarray, opening: np.ndarray) -> np.ndarray:
    return x * np.log1p(opening / x) + opening * np.log(x + opening)


def sample_tables(
    c: np.ndarray, others: np.ndarray, parent: np.ndarray, discount: float, strength: float, rng: np.random.Generator
) -> np.ndarray:
    """Tables of each dish with c customers, given the tables of other dishes and the dish's parent probability.

    Up to `EXACT` customers the number is drawn from its exact conditional distribution. More customers are
    seated one after another; from `EXACT` on the next customer who opens a table is drawn directly, so the work is
    per table, not per customer.
    """
    t = np.ones(len(c), dtype=np.int64)
    table = _log_stirling(discount)
    for k in range(2, EXACT + 1):
        at = np.flatnonzero(c == k)
        if not len(at):
            continue
        steps = np.log((strength + discount * (others[at, None] + np.arange(k))) * parent[at, None])
        weight = np.cumsum(steps, axis=1) + table[k, 1 : k + 1]
        weight = np.exp(weight - weight.max(axis=1, keepdims=True))
        total = np.cumsum(weight, axis=1)
        t[at] = 1 + (total < rng.random(len(at))[:, None] * total[:, -1:]).sum(axis=1)
    at = np.flatnonzero(c > EXACT)
    if not len(at):
        return t
    n, base, p = c[at].astype(float), others[at].astype(float), parent[at]
    own = np.ones(len(at))
    for j in range(1, EXACT):
        opening = (strength + discount * (base + own)) * p
        own += rng.random(len(at)) * (j - discount * own + opening) < opening
    seated = np.full(len(at), float(EXACT))
    live = np.arange(len(at))
    while len(live):
        opening = (strength + discount * (base[live] + own[live])) * p[live]
        start = seated[live] - discount * own[live]
        # the hazard of opening a table at x is log((x + opening) / x); its integral is set to a standard exponential
        goal = _hazard(start, opening) + rng.exponential(size=len(live))
        x = start.copy()
        for _ in range(40):
            move = (goal - _hazard(x, opening)) / np.log1p(opening / x)
            x = np.minimum(np.maximum(x + move, start), 2 * n[live])
            if (np.abs(move) < 0.01 * x).all():
                break
        taken = np.floor(x + discount * own[live])
        opens = taken < n[live]
        live, taken = live[opens], taken[opens]
        own[live] += 1
        seated[live] = np.maximum(taken + 1, seated[live] + 1)
        live = live[seated[live] < n[live]]
    t[at] = own.astype(np.int64)
    return t


@dataclass
class Pairs:
    """What a bucket holds: distinct words and contexts, and pairs sorted by context with their training count."""

    words: np.ndarray
    contexts: np.ndarray
    context: np.ndarray
    word: np.ndarray
    count: np.ndarray

    def block(self) -> bytes:
        key = self.context * np.int64(len(self.words)) + self.word
        return pack(self.contexts, self.words, np.diff(key, prepend=0), self.count)

    @staticmethod
    def of(block: bytes) -> Pairs:
        contexts, words, steps, count = unpack(block)
        key = np.cumsum(steps.astype(np.int64))
        return Pairs(words, contexts, key // len(words), key % len(words), count.astype(np.int64))

    @staticmethod
    def read(blocks: list[tuple[int, bytes]]) -> tuple[Pairs, list[tuple[int, np.ndarray]]]:
        """From (flush, block) in any order; also the pairs of each flush, in the order of its block."""
        blocks_of = sorted(blocks)
        parts = [unpack(b) for _, b in blocks_of]
        contexts, context_at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        words, word_at = np.unique(np.concatenate([p[1] for p in parts]), return_inverse=True)
        keys = []
        w0 = u0 = 0
        for own_contexts, own_words, steps, _ in parts:
            own = np.cumsum(steps.astype(np.int64))
            keys.append(context_at[u0 + own // len(own_words)].astype(np.int64) * len(words) + word_at[w0 + own % len(own_words)])
            w0, u0 = w0 + len(own_words), u0 + len(own_contexts)
        ends = np.cumsum([len(k) for k in keys])
        counts = np.concatenate([p[3] for p in parts])
        del parts
        key, at = np.unique(np.concatenate(keys), return_inverse=True)
        count = np.bincount(at, weights=counts, minlength=len(key)).astype(np.int64)
        slots = np.split(at.astype(np.int32), ends[:-1])
        return Pairs(words, contexts, key // len(words), key % len(words), count), [(f, s) for (f, _), s in zip(blocks_of, slots)]


def _sweep(pairs: Pairs, tables: np.ndarray, total: np.ndarray, parent: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """All dishes reseated once, given the tables of whole restaurants and the parent's probability of each word."""
    again = np.flatnonzero(pairs.count > 1)
    out = tables.copy()
    out[again] = sample_tables(
        pairs.count[again], np.maximum(total[pairs.context[again]] - tables[again], 0), parent[pairs.word[again]], DISCOUNT, STRENGTH, rng
    )
    return out


def _by_owner(hashes: np.ndarray, owners: int) -> list[np.ndarray]:
    """Of each owner, where its names stand, in rising order."""
    owner = (_mix(hashes ^ np.uint64(0xA5A5A5A5)) % np.uint64(owners)).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    return np.split(order, np.searchsorted(owner[order], np.arange(1, owners)))


def _owned(pairs: Pairs, hot: np.ndarray, owners: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(owner, places of its words, places of its hot contexts) of a bucket. Every owner is named, as sums over all words come from all."""
    split = np.flatnonzero(np.isin(pairs.contexts, hot))
    for owner, (w, h) in enumerate(zip(_by_owner(pairs.words, owners), _by_owner(pairs.contexts[split], owners))):
        yield owner, w, split[h]


def _bucket_of(context: np.ndarray, word: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    split = np.isin(context, hot)
    return (np.where(split, _mix(context ^ _mix(word)), _mix(context)) % np.uint64(buckets)).astype(np.int64)


def _deal(held: list[tuple], first_row: int, hot: np.ndarray, buckets: int) -> Iterator[tuple]:
    """(bucket, flush, kind, block) of the documents held: kind 0 are their distinct pairs with the training count, once
    each; kind 1 are the documents, and the entries (pair, times) of each, which stay together."""
    ids = np.array([i if i is not None else 0 for i, _, _ in held], dtype=np.int64)
    none = np.array([i is None for i, _, _ in held], dtype=np.int64)
    out = np.array([o for _, o, _ in held], dtype=np.int64)
    sizes = np.array([len(h) + 1 for _, _, h in held], dtype=np.int64)
    ends = np.cumsum(sizes)
    word = np.full(ends[-1], END, dtype=np.uint64)
    for (_, _, h), end, size in zip(held, ends, sizes):
        word[end - size : end - 1] = h
    names, at = np.unique(np.append(word, BEGIN), return_inverse=True)
    context = np.append(at[-1], at[:-2])
    context[ends[:-1]] = at[-1]
    key, pair = np.unique(context * np.int64(len(names)) + at[:-1], return_inverse=True)
    context, at = key // len(names), key % len(names)
    count = np.bincount(pair, weights=np.repeat(1 - out, sizes), minlength=len(key)).astype(np.int64)
    bucket = _bucket_of(names[context], names[at], hot, buckets)
    order = np.argsort(bucket, kind="stable")
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    entry, times = np.unique(np.repeat(np.arange(len(sizes)), sizes) * np.int64(len(key)) + place[pair], return_counts=True)
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    yield int(first_row % buckets), first_row, 1, pack(
        ids.view(np.uint64), none, out, sizes, np.diff(entry, prepend=0), times,
        bucket[order][cuts],
    )
    for part in np.split(order, cuts[1:]):
        run = np.flatnonzero(np.append(True, context[part][1:] != context[part][:-1]))
        words, word_at = np.unique(at[part], return_inverse=True)
        context_at = np.repeat(np.arange(len(run)), np.diff(np.append(run, len(part))))
        yield int(bucket[part[0]]), first_row, 0, Pairs(names[words], names[context[part][run]], context_at, word_at, count[part]).block()


def _rows(rows: list[tuple], names: str, kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names.split())


def hot_contexts(texts: DataFrame, buckets: int) -> np.ndarray:
    """Hashes of all contexts with more than a quarter of a bucket's tokens; none with less than an eighth, so at most 8 per bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def summed() -> pa.RecordBatch:
            words, n = np.unique(np.concatenate(held), return_counts=True)
            # what is left out here is less than an eighth of a bucket's share over all chunks together
            often = n * 8 * buckets >= size
            words, n = words[often], n[often]
            return pa.RecordBatch.from_arrays([pa.array([None, *words.view(np.int64).tolist()], pa.int64()), pa.array([size, *n.tolist()], pa.int64())], ["word", "n"])

        for batch in batches:
            for text in batch.column("text").cast(pa.large_binary()).to_pylist():
                held.append(np.append(word_hashes(text), BEGIN))
                size += len(held[-1])
                if size >= HELD_TOKENS:
                    yield summed()
                    held, size = [], 0
        if held:
            yield summed()

    counts = texts.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "word").limit(8 * buckets + 1).collect()
    total = next((r["n"] for r in top if r["word"] is None), 0)
    return np.sort(np.array([r["word"] for r in top if r["word"] is not None and r["n"] * 8 * buckets > total], dtype=np.int64).view(np.uint64))


def score_documents(docs: DataFrame, folds: int = 7, held_fold: int = 2, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity), one row per document row.

    Tokens are the words and one end. The model and the counts come from the documents outside the held-out fold; null
    ids are not held out. Null and empty texts have the end as their only token. score is the log10 probability of the
    tokens, each given the one before; base_score that of add-one counts. Word identity is a 64-bit hash. Repeated rows count
    and score each by themselves. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    texts = id_and_text(docs)
    buckets = max(LEAST_BUCKETS, -(-text_bytes(docs) // bucket_bytes))
    owners = -(-buckets // BUCKETS_PER_OWNER)
    hot = hot_contexts(texts, buckets)
    held = F.coalesce(fold_of(F.col("doc_id"), folds) == held_fold, F.lit(False)).cast("int")
    rows = texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", held.alias("held"), "text")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple] = []
        first = size = 0
        names, kinds = "bucket flush kind block", [pa.int32(), pa.int64(), pa.int32(), pa.binary()]
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("row", "doc_id", "held")]
            for row, doc_id, out, text in zip(*columns, batch.column("text").cast(pa.large_binary()).to_pylist()):
                if not kept:
                    first = row
                kept.append((doc_id, out, word_hashes(text)))
                size += len(kept[-1][2]) + 1
                if size >= HELD_TOKENS:
                    yield _rows(list(_deal(kept, first, hot, buckets)), names, kinds)
                    kept, size = [], 0
        if kept:
            yield _rows(list(_deal(kept, first, hot, buckets)), names, kinds)

    dealt = rows.mapInArrow(deal, "bucket int, flush long, kind int, block binary").repartition(buckets, "bucket")
    pairs = dealt.groupBy("bucket").applyInArrow(_pairs, "bucket int, block binary").repartition(buckets, "bucket")
    mail = "round int, to int, sender int, kind int, block binary"
    named = pairs.groupBy("bucket").applyInArrow(_name(hot, owners), mail).repartition(owners, "to")
    asked = pairs.groupBy("bucket").applyInArrow(_start(hot, owners), mail)
    samples = []
    for sweep in range(BURN_IN + SAMPLES + 1):
        asked = asked.repartition(owners, "to")
        told = named.groupBy("to").cogroup(asked.groupBy("to")).applyInArrow(_tell(sweep), mail).repartition(buckets, "to")
        if sweep > BURN_IN:
            samples.append(told)
        if sweep < BURN_IN + SAMPLES:
            asked = pairs.groupBy("bucket").cogroup(told.groupBy("to")).applyInArrow(_ask(sweep + 1, hot, owners), mail)
    sampled = reduce(DataFrame.union, samples).repartition(buckets, "to")
    scored = dealt.groupBy("bucket").cogroup(sampled.groupBy("to")).applyInArrow(
        _score(hot, buckets, owners), "to int, flush long, bucket int, block binary"
    )
    return dealt.groupBy("bucket").cogroup(scored.repartition(buckets, "to").groupBy("to")).applyInArrow(
        _gather, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    )


# kinds of messages: to the owner of words and back, what a bucket and an owner keep for themselves, and names for owners
ASK, REPLY, SEATING, PARENT, NAMES = range(5)
_MAIL = [("round", pa.int32()), ("to", pa.int32()), ("sender", pa.int32()), ("kind", pa.int32()), ("block", pa.binary())]


def _table(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.table([pa.array(c, k) for c, (_, k) in zip(columns, schema)], names=[n for n, _ in schema])


def _tokens(table: pa.Table) -> list[tuple[int, bytes]]:
    """(flush, block) of the token rows of a bucket."""
    columns = (table.column(c).to_pylist() for c in ("flush", "kind", "block"))
    return [(flush, block) for flush, kind, block in zip(*columns) if kind == 0]


def _pairs(key: tuple, table: pa.Table) -> pa.Table:
    """Per bucket: its pairs, summed over flushes."""
    blocks = _tokens(table)
    rows = [(key[0].as_py(), Pairs.read(blocks)[0].block())] if blocks else []
    return _table(rows, [("bucket", pa.int32()), ("block", pa.binary())])


def _mail(table: pa.Table, kind: int) -> list[tuple[int, bytes]]:
    """(sender, block) of the messages of a kind, by sender."""
    rows = zip(*(table.column(c).to_pylist() for c in ("sender", "kind", "block")))
    return sorted((sender, block) for sender, k, block in rows if k == kind)


def _name(hot: np.ndarray, owners: int):
    """Per bucket: its words and hot contexts, to their owners."""

    def name(key: tuple, table: pa.Table) -> pa.Table:
        bucket, pairs = key[0].as_py(), Pairs.of(table.column("block")[0].as_py())
        return _table([(0, owner, bucket, NAMES, pack(pairs.words[w], pairs.contexts[h])) for owner, w, h in _owned(pairs, hot, owners)], _MAIL)

    return name


def _questions(sweep: int, bucket: int, pairs: Pairs, tables: np.ndarray, known: tuple[int, int], hot: np.ndarray, owners: int) -> list[tuple]:
    """The seating, kept, and the tables of words and hot contexts, to their owners; counts only go with the last sweep."""
    word, context = ([np.bincount(at, weights=x, minlength=n).astype(np.int64) for x in (tables, pairs.count)]
                     for at, n in ((pairs.word, len(pairs.words)), (pairs.context, len(pairs.contexts))))
    out = [(sweep, bucket % owners, bucket, SEATING, pack(tables))]
    for owner, w, h in _owned(pairs, hot, owners):
        counts = (word[1][w], context[1][h]) if sweep == BURN_IN + SAMPLES else (w[:0], h[:0])
        out.append((sweep, owner, bucket, ASK, pack(word[0][w], context[0][h], *counts, np.array(known))))
    return out


def _start(hot: np.ndarray, owners: int):
    """Per bucket: one table for each pair."""

    def start(key: tuple, table: pa.Table) -> pa.Table:
        bucket, pairs = key[0].as_py(), Pairs.of(table.column("block")[0].as_py())
        return _table(_questions(0, bucket, pairs, (pairs.count > 0).astype(np.int64), (0, 0), hot, owners), _MAIL)

    return start


@dataclass
class State:
    """A bucket's seating after a sweep, the tables of its restaurants over all buckets, and what the owners told."""

    tables: np.ndarray
    total: np.ndarray
    parent: np.ndarray
    count: np.ndarray
    context_count: np.ndarray
    known: tuple[int, int]
    tokens: int

    @staticmethod
    def of(pairs: Pairs, table: pa.Table, hot: np.ndarray, owners: int) -> State:
        tables = unpack(_mail(table, SEATING)[0][1])[0].astype(np.int64)
        total = np.bincount(pairs.context, weights=tables, minlength=len(pairs.contexts))
        context_count = np.bincount(pairs.context, weights=pairs.count, minlength=len(pairs.contexts))
        customers, seated, count = (np.zeros(len(pairs.words), dtype=np.int64) for _ in range(3))
        replies = dict(_mail(table, REPLY))
        sums = np.zeros(4, dtype=np.int64)
        for owner, w, h in _owned(pairs, hot, owners):
            found = unpack(replies[owner])
            customers[w], seated[w], total[h] = found[:3]
            if len(found[3]):
                count[w] = found[3]
            if len(found[4]):
                context_count[h] = found[4]
            sums += found[5].astype(np.int64)
        words, tokens, all_customers, all_tables = sums.tolist()
        parent = parent_probability(customers, seated, all_customers, all_tables, words)
        return State(tables, total, parent, count, context_count, (words, all_tables), tokens)


def _ask(sweep: int, hot: np.ndarray, owners: int):
    """Per bucket: a sweep given what the last one left everywhere, and its tables to the owners."""

    def ask(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        out = []
        for owner, block in _mail(told, PARENT):
            out.append((sweep, owner, owner, PARENT, block))
        if table.num_rows:
            bucket, pairs = key[0].as_py(), Pairs.of(table.column("block")[0].as_py())
            state = State.of(pairs, told, hot, owners)
            tables = _sweep(pairs, state.tables, state.total, state.parent, np.random.default_rng((SEED, sweep, bucket)))
            out += _questions(sweep, bucket, pairs, tables, state.known, hot, owners)
        return _table(out, _MAIL)

    return ask


def _tell(sweep: int):
    """Per owner: the parent's tables of its words reseated, and the sums of its words and hot contexts, to all that asked."""

    def tell(key: tuple, named: pa.Table, table: pa.Table) -> pa.Table:
        owner = key[0].as_py()
        out = [(sweep, bucket, bucket, SEATING, block) for bucket, block in _mail(table, SEATING)]
        asked = [(bucket, unpack(block)) for bucket, block in _mail(table, ASK)]
        names = [unpack(block) for _, block in _mail(named, NAMES)]
        last = sweep == BURN_IN + SAMPLES

        def places(kind: int) -> tuple[np.ndarray, int]:
            found, at = np.unique(np.concatenate([n[kind] for n in names]), return_inverse=True)
            return at, len(found)

        def summed(at: np.ndarray, n: int, value: int) -> np.ndarray:
            return np.bincount(at, weights=np.concatenate([p[value] for _, p in asked]), minlength=n).astype(np.int64)

        if asked:
            (at, n), (hot_at, n_hot) = places(0), places(1)
            customers, hot_tables = summed(at, n, 0), summed(hot_at, n_hot, 1)
            count, hot_count = (summed(at, n, 2), summed(hot_at, n_hot, 3)) if last else (customers[:0], hot_tables[:0])
            words, all_tables = asked[0][1][4].tolist()
            tables = (customers > 0).astype(np.int64)
            if sweep:
                before = unpack(_mail(table, PARENT)[0][1])[0].astype(np.int64)
                again = np.flatnonzero(customers > 1)
                others = np.maximum(all_tables - before[again], 0)
                tables[again] = sample_tables(
                    customers[again], others, np.full(len(again), 1 / (words + 1)), ROOT_DISCOUNT, ROOT_STRENGTH, np.random.default_rng((SEED, sweep, owner, 1))
                )
            out.append((sweep, owner, owner, PARENT, pack(tables)))
            sums = np.array([(customers > 0).sum(), count.sum(), customers.sum(), tables.sum()])
            w0 = h0 = 0
            for bucket, p in asked:
                w, h = at[w0 : w0 + len(p[0])], hot_at[h0 : h0 + len(p[1])]
                w0, h0 = w0 + len(p[0]), h0 + len(p[1])
                counts = (count[w], hot_count[h]) if last else (count, hot_count)
                out.append((sweep, bucket, owner, REPLY, pack(customers[w], tables[w], hot_tables[h], *counts, sums)))
        return _table(out, _MAIL)

    return tell


def parent_probability(customers: np.ndarray, tables: np.ndarray, all_customers: float, all_tables: float, words: int) -> np.ndarray:
    """Of each word in the parent restaurant; what it holds back is spread evenly over all words and one unknown."""
    kept = customers - ROOT_DISCOUNT * tables
    return (kept + (ROOT_STRENGTH + ROOT_DISCOUNT * all_tables) / (words + 1)) / (all_customers + ROOT_STRENGTH)


def rounded(chance: np.ndarray) -> np.ndarray:
    """Chances to 16 significant bits, 0.000007 in the logarithm: far finer than the spread of the samples, and a byte less to send."""
    bits = chance.astype(np.float32).view(np.uint32)
    return ((bits + np.uint32(0x80)) & np.uint32(0xFFFFFF00)).view(np.float32)


def _score(hot: np.ndarray, buckets: int, owners: int):
    """Per bucket: the chance of each pair, averaged over the joint samples, and the count of its word, to the flushes that have it."""
    schema = [("to", pa.int32()), ("flush", pa.int64()), ("bucket", pa.int32()), ("block", pa.binary())]

    def score(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        blocks = _tokens(table)
        if not blocks:
            return _table([], schema)
        bucket = key[0].as_py()
        pairs, slots = Pairs.read(blocks)
        rounds = np.array(told.column("round").to_pylist())
        states = (State.of(pairs, told.filter(pa.array(rounds == r)), hot, owners) for r in sorted(set(rounds.tolist()), reverse=True))
        chance, last = np.zeros(len(pairs.count)), None
        for state in states:
            # the last sample comes first, and the counts came with it
            last = last or state
            own = np.where(pairs.count > 0, pairs.count - DISCOUNT * state.tables, 0)
            below = STRENGTH + DISCOUNT * state.total[pairs.context]
            chance += (own + below * state.parent[pairs.word]) / (last.context_count[pairs.context] + STRENGTH) / SAMPLES
        count, sums = last.count[pairs.word], np.array([last.known[0], last.tokens])
        chance = rounded(chance)
        return _table([(flush % buckets, flush, bucket, pack(chance[at], count[at], sums)) for flush, at in slots], schema)

    return score


def _gather(key: tuple, table: pa.Table, scored: pa.Table) -> pa.Table:
    """Per flush: the documents with the sums over their entries."""
    found: dict[tuple[int, int], bytes] = dict(zip(zip(scored.column("flush").to_pylist(), scored.column("bucket").to_pylist()), scored.column("block").to_pylist()))
    parts = []
    for flush, kind, block in zip(*(table.column(c).to_pylist() for c in ("flush", "kind", "block"))):
        if kind == 0:
            continue
        ids, none, out, sizes, steps, times, buckets = unpack(block)
        replies = [unpack(found[flush, b]) for b in buckets.tolist()]
        chance = np.log10(np.concatenate([r[0] for r in replies]).astype(float))
        count = np.concatenate([r[1].astype(np.int64) for r in replies])
        n_words, n_tokens = replies[0][2].tolist()
        base = np.log10((count + 1) / (n_tokens + n_words + 1))
        entry = np.cumsum(steps.astype(np.int64))
        doc, pair = entry // len(chance), entry % len(chance)
        score, base, known = (np.bincount(doc, weights=v[pair] * times, minlength=len(ids)) for v in (chance, base, (count > 0).astype(float)))
        sizes = sizes.astype(np.int64)
        parts.append(pa.table({
            "doc_id": pa.array(ids.view(np.int64), mask=none == 1), "held_out": pa.array(out == 1), "n_tokens": pa.array(sizes),
            "n_known": pa.array(np.round(known).astype(np.int64)), "train_tokens": pa.array(np.full(len(ids), n_tokens)),
            "base_score": pa.array(base), "score": pa.array(score), "perplexity": pa.array(10 ** np.minimum(-score / sizes, 300)),
        }))
    names = "doc_id held_out n_tokens n_known train_tokens base_score score perplexity".split()
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
    return pa.concat_tables(parts) if parts else _table([], list(zip(names, kinds)))
