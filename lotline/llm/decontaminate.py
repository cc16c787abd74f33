"""Benchmark decontamination: a BM25 index of the test items, searched with every training passage.

Scores are BM25 contributions divided by the item's score for its own words, so 1 means that a passage has all
words of the item. Every passage (overlapping windows long enough to hold any item whole) is a query; block-max
WAND retrieves all items at the threshold or above. An item retrieved is then verified: enough of its word shingles
must be in the passage in order, and enough of the words of both its question and its answer. An item of fewer words than a shingle
has none to tell a leak by inside other text; it counts as found where it stands as sentences of its own.

The index is made in parts of bounded text size, and every part meets every passage, so no item table is too large.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotline.llm.common import id_and_text, small_batches
from lotline.staging import stage

K1, B = 1.2, 0.75
THRESHOLD = 0.6
SHINGLE = 5
SIMILARITY = 0.8
PART_OVERLAP = 0.5
MIN_STRIDE = 64
BLOCK = 4
# cells of the block bounds of a text's passages that are held at once
CELLS = 1 << 23
# bytes of item text in one part of the index, which goes to every executor
PART_BYTES = 1 << 18
PIECE = 1 << 22
# a longer sentence is no short item
_SHORT_TEXT = 1 << 10
# scripts that put no spaces between words: Thai, Lao, Myanmar, Khmer, Kana, Han
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_WORD = re.compile(rf"[^\W_{_UNSPACED}]+|(?=[^\W_])[{_UNSPACED}]")
_SENTENCE_END = re.compile(r"[.!?]+(?:\s+|$)|\n+")
_PAIR = "doc_id long, item_id long, score double, overlap double, question_overlap double, answer_overlap double"


def words_of(text: str) -> list[str]:
    """Words of a text in lower case: runs of letters and digits; in scripts without spaces every letter."""
    return _WORD.findall(text.lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of all sentences but the last, and of the last; a single sentence is both."""
    parts = [w for w in (words_of(s) for s in _SENTENCE_END.split(text)) if w]
    if len(parts) < 2:
        return words_of(text), words_of(text)
    return [w for p in parts[:-1] for w in p], parts[-1]


@dataclass
class Index:
    """Postings of one part of the items, ordered by item length, with the largest weight per term and block."""

    item_ids: list[int]
    questions: list[np.ndarray]
    answers: list[np.ndarray]
    shingles: list[frozenset[bytes]]
    widths: list[int]
    terms: dict[str, int]
    postings: list[tuple[list[int], list[float]]]
    block_max: np.ndarray
    stride: int
    short: dict[tuple[str, ...], list[int]]

    @staticmethod
    def build(items: list[tuple[int, list[str], list[str]]], df: dict[str, int], n_items: int, mean_words: float) -> Index:
        """items: (item_id, question words, answer words), where a single sentence has the same list twice."""
        whole = [(i, q if q == a else q + a, q, a) for i, q, a in items]
        short: dict[tuple[str, ...], list[int]] = {}
        for i, w, _, _ in whole:
            if len(w) < SHINGLE:
                short.setdefault(tuple(w), []).append(i)
        whole = [x for x in whole if len(x[1]) >= SHINGLE]
        whole.sort(key=lambda x: (len(x[1]), x[0]))
        terms: dict[str, int] = {}
        for _, w, _, _ in whole:
            for word in w:
                terms.setdefault(word, len(terms))
        found: list[tuple[list[int], list[float]]] = [([], []) for _ in terms]
        for at, (_, w, _, _) in enumerate(whole):
            weights = {}
            for word, n in Counter(w).items():
                idf = math.log(1 + (n_items - df[word] + 0.5) / (df[word] + 0.5))
                weights[word] = idf * n * (K1 + 1) / (n + K1 * (1 - B + B * len(w) / mean_words))
            total = sum(weights.values())
            for word, weight in weights.items():
                found[terms[word]][0].append(at)
                found[terms[word]][1].append(weight / total)
        block_max = np.zeros((len(terms), -(-len(whole) // BLOCK)), dtype=np.float32)
        for t, (at, weight) in enumerate(found):
            np.maximum.at(block_max[t], np.array(at) // BLOCK, np.array(weight, dtype=np.float32))
        # float32 rounding must not lower a bound
        block_max = np.nextafter(block_max, np.float32(2), where=block_max > 0, out=block_max)
        code = lambda ws: np.array([terms[x] for x in ws], dtype=np.int32)
        coded = [code(w) for _, w, _, _ in whole]
        widths = [min(SHINGLE, len(c)) for c in coded]
        return Index(
            [i for i, _, _, _ in whole], [code(q) for _, _, q, _ in whole], [code(a) for _, _, _, a in whole],
            [frozenset(_grams(c, w)) for c, w in zip(coded, widths)], widths, terms, found, block_max,
            max(MIN_STRIDE, max((len(c) for c in coded), default=0)), short,
        )


def _grams(ids: np.ndarray, width: int) -> list[bytes]:
    raw, step = ids.astype(np.int32).tobytes(), 4
    return [raw[i * step : (i + width) * step] for i in range(len(ids) - width + 1)]


def block_max_wand(index: Index, terms: list[int], threshold: float) -> list[tuple[int, float]]:
    """(item place, score) of all items whose summed weight of `terms` reaches the threshold."""
    lists = []
    for t in terms:
        places, weights = index.postings[t]
        lists.append([places, weights, 0, max(weights), t])
    out, end, bound = [], len(index.item_ids), threshold - 1e-6
    while lists:
        lists.sort(key=lambda c: c[0][c[2]])
        upper, pivot = 0.0, -1
        for i, c in enumerate(lists):
            upper += c[3]
            if upper >= bound:
                pivot = i
                break
        if pivot < 0:
            break
        at = lists[pivot][0][lists[pivot][2]]
        while pivot + 1 < len(lists) and lists[pivot + 1][0][lists[pivot + 1][2]] == at:
            pivot += 1
        block = at // BLOCK
        if sum(float(index.block_max[c[4], block]) for c in lists[: pivot + 1]) >= bound:
            if lists[0][0][lists[0][2]] == at:
                score = sum(c[1][c[2]] for c in lists[: pivot + 1])
                if score >= bound:
                    out.append((at, score))
            else:
                _advance(lists[:pivot], at)
                lists = [c for c in lists if c[2] < len(c[0])]
                continue
            goal = at + 1
        else:
            # no item can reach the threshold before the block ends or another list starts
            goal = min((block + 1) * BLOCK, end, *[c[0][c[2]] for c in lists[pivot + 1 : pivot + 2]])
            goal = max(goal, at + 1)
        _advance(lists[: pivot + 1], goal)
        lists = [c for c in lists if c[2] < len(c[0])]
    return out


def _advance(lists: list[list], goal: int) -> None:
    for c in lists:
        if c[0][c[2]] < goal:
            c[2] = bisect_left(c[0], goal, c[2])


def search(index: Index, text: str, threshold: float = THRESHOLD, similarity: float = SIMILARITY) -> list[tuple]:
    """(item_id, score, overlap, question overlap, answer overlap) of each verified item, its best passage each."""
    short = [(i, 1.0, 1.0, 1.0, 1.0) for i in short_items(index, text)] if index.short else []
    return short + _search_passages(index, text, threshold, similarity)


def short_items(index: Index, text: str) -> list[int]:
    """Items of fewer words than a shingle that are one or more whole sentences or lines of the text in a row."""
    found: set[int] = set()
    open_: list[list[str]] = []  # words since the start of each of the last sentences
    for sentence in _SENTENCE_END.split(text):
        words = words_of(sentence) if len(sentence) < _SHORT_TEXT else [""] * SHINGLE
        if not words:
            continue
        open_ = [w + words for w in open_ if len(w) + len(words) < SHINGLE]
        if len(words) < SHINGLE:
            open_.append(words)
        for w in open_:
            found.update(index.short.get(tuple(w), ()))
    return sorted(found)


def _search_passages(index: Index, text: str, threshold: float, similarity: float) -> list[tuple]:
    get = index.terms.get
    parts = []
    for piece in _pieces(text):
        words = words_of(piece)
        parts.append(np.fromiter((get(w, -1) for w in words), dtype=np.int32, count=len(words)))
    ids = np.concatenate(parts) if len(parts) > 1 else parts[0]
    stride = index.stride
    n_passages = max(1, -(-len(ids) // stride) - 1)
    at = np.flatnonzero(ids >= 0)
    if not len(at):
        return []
    # a word lies in the passage that starts in its stride and in the one before
    own = at // stride
    passage = np.concatenate((own, own - 1))
    term = np.concatenate((ids[at], ids[at]))
    inside = (passage >= 0) & (passage < n_passages)
    width = np.int64(len(index.terms))
    keys = np.unique(passage[inside].astype(np.int64) * width + term[inside])
    passage, term = keys // width, (keys % width).astype(np.int32)
    first = np.flatnonzero(np.diff(passage, prepend=-1))
    upper = _upper_bounds(index, term, first)
    best: dict[int, tuple] = {}
    for k in np.flatnonzero(upper >= threshold - 1e-5):
        p = int(passage[first[k]])
        own_terms = term[first[k] : first[k + 1] if k + 1 < len(first) else len(term)]
        for place, score in block_max_wand(index, own_terms.tolist(), threshold):
            window = ids[p * stride : (p + 2) * stride]
            grams = index.shingles[place]
            overlap = len(grams & set(_grams(window, index.widths[place]))) / len(grams)
            if overlap < similarity:
                continue
            parts = [_bag_overlap(x[place], window) for x in (index.questions, index.answers)]
            found = (overlap, score, *parts)
            if min(parts) >= PART_OVERLAP and found > best.get(place, (0.0,)):
                best[place] = found
    return [(index.item_ids[place], s, o, q, a) for place, (o, s, q, a) in sorted(best.items())]


def _upper_bounds(index: Index, term: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The most that any block can score in each passage; so many passages at once that the table of bounds stays small."""
    ends, out = np.append(first[1:], len(term)), np.empty(len(first))
    rows = max(1, CELLS // max(1, index.block_max.shape[1]))
    at = 0
    while at < len(first):
        to = max(at + 1, int(np.searchsorted(ends, first[at] + rows, side="right")))
        part = index.block_max[term[first[at] : ends[to - 1]]]
        out[at:to] = np.add.reduceat(part, first[at:to] - first[at], axis=0).max(axis=1)
        at = to
    return out


def _pieces(text: str) -> list[str]:
    """A very long text cut at white space, so that the words of one piece fit in memory."""
    out, start = [], 0
    while len(text) - start > PIECE:
        cut = max(text.rfind(" ", start, start + PIECE), text.rfind("\n", start, start + PIECE))
        if cut <= start:
            break
        out.append(text[start:cut])
        start = cut
    return [*out, text[start:]]


def _bag_overlap(words: np.ndarray, window: np.ndarray) -> float:
    """Share of the words, repeats included, that the window has as often."""
    values, counts = np.unique(words, return_counts=True)
    have = np.array([(window == v).sum() for v in values])
    return float(np.minimum(counts, have).sum() / counts.sum())


def build_indexes(items: DataFrame, part_bytes: int = PART_BYTES) -> Iterator[Index]:
    """The index in parts of at most about `part_bytes` of text; idf and length counts are those of all items.

    Items without an id or without a word are left out. Repeated rows count once. The driver holds one part at a time.
    """
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where(
        "item_id is not null and text is not null"
    ).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    n_parts = max(1, -(-int(size) // part_bytes))
    words = T.ArrayType(T.StringType())

    @F.pandas_udf(T.StructType([T.StructField("question", words), T.StructField("answer", words)]))
    def split(texts):
        found = [question_and_answer(t) for t in texts]
        return texts.to_frame().assign(question=[q for q, _ in found], answer=[a for _, a in found])[["question", "answer"]]

    parsed = items.withColumn("qa", split("text")).select(
        "item_id", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_parts)).alias("part"), "qa.question", "qa.answer",
        F.when(F.col("qa.question") == F.col("qa.answer"), F.col("qa.question")).otherwise(F.concat("qa.question", "qa.answer")).alias("words"),
    )
    parsed = stage(parsed.where(F.size("words") > 0), "items")
    n, mean = parsed.agg(F.count("*"), F.avg(F.size("words"))).head()
    terms = parsed.select("part", F.explode(F.array_distinct("words")).alias("word"))
    df = stage(terms.groupBy("word").agg(F.count("*").alias("df")), "item-terms")
    for part in range(n_parts if n else 0):
        rows = parsed.where(F.col("part") == part).select("item_id", "question", "answer").collect()
        own = terms.where(F.col("part") == part).select("word").distinct().join(df, "word").collect()
        if rows:
            yield Index.build([(r["item_id"], r["question"], r["answer"]) for r in rows], {r["word"]: r["df"] for r in own}, n, mean)


def find_leaks(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, similarity: float = SIMILARITY, part_bytes: int = PART_BYTES
) -> DataFrame:
    """(doc_id, item_id, score, overlap, question_overlap, answer_overlap): one row per document row and item in it.

    Null and empty texts have no leak, and repeated rows give repeated results. Without items the result is empty.
    """
    small_batches(docs.sparkSession)
    texts = id_and_text(docs)
    found = []
    for index in build_indexes(items, part_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(index)
        found.append(texts.mapInArrow(_searcher(shared, threshold, similarity), _PAIR))
    if not found:
        return docs.sparkSession.createDataFrame([], _PAIR)
    return reduce(DataFrame.unionByName, found)


def _searcher(shared, threshold: float, similarity: float):
    names = [f.split()[0] for f in _PAIR.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (i, *hit)
                for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
                for hit in search(shared.value, t, threshold, similarity)
            ]
            columns = list(zip(*rows)) if rows else [()] * len(names)
            kinds = [pa.int64(), pa.int64(), *[pa.float64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def keep_clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, similarity: float = SIMILARITY) -> DataFrame:
    """Rows whose text holds no item, all columns as given; null texts stay."""
    small_batches(docs.sparkSession)
    for index in build_indexes(items):
        docs = docs.where(~_holds(docs.sparkSession.sparkContext.broadcast(index), threshold, similarity)(F.col("text")))
    return docs


def _holds(shared, threshold: float, similarity: float):
    @F.pandas_udf(T.BooleanType())
    def holds(texts):
        return texts.fillna("").map(lambda t: bool(search(shared.value, t, threshold, similarity)))

    return holds
