"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Folding maps look-alike characters and digits to one letter each, so that disguised spellings meet the
lexicon. Lexicon entries are words and word beginnings with a weight; exception phrases are two words in
a row that hold an entry but stand for harmless use, and take its weight back. The sum of the weights is
normalised by the length of the text and mapped to a score by a one-variable logistic fit.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotline.llm.common import drawn, fold_of, id_and_text, small_batches
from lotline.staging import stage

# Characters that look like a Latin letter. i, l, 1 and their like are one class, written i.
LOOK_ALIKES = {
    "a": "аαａ@4", "b": "вβｂ8", "c": "сϲｃ", "d": "ԁｄ", "e": "еεｅ3€", "f": "ｆ", "g": "ɡｇ9", "h": "һｈ", "i": "іιｉl1|!ӏⅼｌ", "j": "јｊ",
    "k": "кκｋ", "m": "мｍ", "n": "ոｎ", "o": "оοｏ0", "p": "рρｐ", "q": "ԛｑ", "r": "гｒ", "s": "ѕｓ$5", "t": "тτｔ7+",
    "u": "υսｕ", "v": "νѵｖ", "w": "ԝωｗ", "x": "хχｘ", "y": "уγｙ", "z": "ᴢｚ2",
}
FOLD = str.maketrans({c: letter for letter, like in LOOK_ALIKES.items() for c in like})
_INNER = re.compile(r"[^\W_](?:[^\s]*[^\W_])?")
_PLAIN = re.compile(r"[^\W\d_]+")

# bound of the labelled rows that the lexicon is learned from, spread evenly over all of them
FIT_DOCS = 20_000
MIN_DOCS = 4
MIN_PRECISION = 0.8
STEMS = range(4, 8)
MAX_ENTRIES = 20_000
_BLANK = re.compile(" ")
# distinct terms that a task counts before it hands them on
HELD_TERMS = 50_000


def folded_words(text: str) -> list[str]:
    """Words of a text, lower case and folded.

    A word is what lies between white space, from its first to its last letter or digit, so signs inside it are
    folded and signs around it fall off. Without any letter it is no word.
    """
    out = []
    for raw in text.lower().split():
        if raw.isalpha():
            out.append(raw.translate(FOLD))
            continue
        inner = _INNER.search(raw)
        if inner is None or not _PLAIN.search(inner[0]):
            continue
        out += _PLAIN.findall(inner[0].translate(FOLD))
    return out


@dataclass
class Lexicon:
    """Weights of entries (a trailing * marks a word beginning), exception phrases, and the logistic map."""

    weights: Mapping[str, float]
    exceptions: frozenset[str] = frozenset()
    slope: float = 1.0
    offset: float = 0.0
    _machine: object = field(default=None, repr=False, compare=False)

    def machine(self):
        """The automaton over all entries; a space stands for a word's edge."""
        if self._machine is None:
            self._machine = ahocorasick.Automaton()
            for entry, weight in self.weights.items():
                key = f" {entry[:-1]}" if entry.endswith("*") else f" {entry} "
                self._machine.add_word(key, (len(key), entry.endswith("*"), weight))
            self._machine.make_automaton()
        return self._machine

    def density(self, words: list[str]) -> float:
        """Weight of the matches outside exception phrases, per logarithm of the length in words.

        Of several entries that match one word the heaviest counts.
        """
        if not self.weights or not words:
            return 0.0
        line = f" {' '.join(words)} "
        best: dict[int, float] = {}
        for end, (length, _, weight) in self.machine().iter(line):
            start = end - length + 2
            best[start] = max(weight, best.get(start, weight))
        total = 0.0
        for start, weight in best.items():
            stop = line.index(" ", start)
            if self.exceptions:
                before = line.rfind(" ", 0, start - 1) + 1 if start > 1 else start
                after = line.find(" ", stop + 1)
                if line[before:stop] in self.exceptions or line[start : after if after > 0 else stop] in self.exceptions:
                    continue
            total += weight
        return total / math.log2(2 + len(words))

    def score(self, density: float) -> float:
        z = self.slope * density + self.offset
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0

    def __getstate__(self):
        return {"weights": dict(self.weights), "exceptions": self.exceptions, "slope": self.slope, "offset": self.offset, "_machine": None}


def _terms(words: list[str]) -> set[str]:
    """What a document offers as lexicon entries."""
    distinct = set(words)
    return {w for w in distinct if len(w) > 2} | {f"{w[:n]}*" for w in distinct for n in STEMS if len(w) > n}


def _term_rows(counts: dict[int, Counter]) -> pa.RecordBatch:
    clean, toxic = counts[0], counts[1]
    terms = [*toxic.keys() | clean.keys()]
    arrays = [pa.array(terms, pa.string()), pa.array([toxic[t] for t in terms], pa.int64()), pa.array([clean[t] for t in terms], pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, ["term", "toxic", "clean"])


def _labelled(docs: DataFrame, labels: DataFrame, train: Column, fit_docs: int) -> DataFrame:
    """(text, y) of a bounded, evenly spread sample of the training rows with a label."""
    known = labels.where("toxic is not null").groupBy(F.col("doc_id").alias("_label_id")).agg(F.max("toxic").cast("int").alias("y"))
    known = known.where(train)
    known = known.where(drawn(F.xxhash64("_label_id", F.lit("toxic")), fit_docs, known.count()))
    texts = id_and_text(docs)
    return texts.join(known, texts["doc_id"] == known["_label_id"]).select("text", "y")


def learn_lexicon(
    docs: DataFrame, labels: DataFrame, train: Column, fit_docs: int = FIT_DOCS, min_docs: int = MIN_DOCS,
    min_precision: float = MIN_PRECISION,
) -> Lexicon:
    """A lexicon from labelled rows; `train` is a condition on `_label_id`.

    Terms that `min_docs` or more toxic documents hold and that are toxic in at least `min_precision` of all
    documents with them become entries, weighted by their smoothed log odds. A word beginning replaces
    the longer ones and the words it covers. Without toxic training rows the lexicon is empty and scores are low.
    """
    small_batches(docs.sparkSession)
    sample = stage(_labelled(docs, labels, train, fit_docs), "labelled")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = {0: Counter(), 1: Counter()}
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
                counts[y].update(_terms(folded_words(text)))
                if len(counts[0]) + len(counts[1]) > HELD_TERMS:
                    yield _term_rows(counts)
                    counts = {0: Counter(), 1: Counter()}
            yield _term_rows(counts)

    total = sample.agg(F.count_if(F.col("y") == 1).alias("toxic"), F.count_if(F.col("y") == 0).alias("clean")).head()
    if not total["toxic"]:
        return Lexicon({}, offset=-5.0)
    terms = sample.mapInArrow(count, "term string, toxic long, clean long").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    )
    odds = F.log((F.col("toxic") + 0.5) / (total["toxic"] + 1)) - F.log((F.col("clean") + 0.5) / (total["clean"] + 1))
    useful = terms.where((F.col("toxic") >= min_docs) & (F.col("toxic") >= min_precision * (F.col("toxic") + F.col("clean"))))
    rows = useful.select("term", "toxic", odds.alias("weight")).orderBy(F.desc("weight"), "term").limit(MAX_ENTRIES).collect()
    weights = _shortest({r["term"]: r["weight"] for r in rows})
    exceptions = _learn_exceptions(sample, weights, min_docs)
    return _calibrated(sample, Lexicon(weights, exceptions))


def _shortest(found: dict[str, float]) -> dict[str, float]:
    """Entries without those that a word beginning in the lexicon covers."""
    stems = {t[:-1] for t in found if t.endswith("*")}
    out = {}
    for term, weight in found.items():
        word = term.rstrip("*")
        inner = range(STEMS.start, len(word) if term.endswith("*") else len(word) + 1)
        if not any(word[:n] in stems for n in inner if f"{word[:n]}*" != term):
            out[term] = weight
    return out


def _learn_exceptions(sample: DataFrame, weights: dict[str, float], min_docs: int) -> frozenset[str]:
    """Phrases of two words around an entry that only documents without a toxic label hold, `min_docs` of them or more; the most frequent
    `MAX_ENTRIES`, ties by the phrase."""
    lexicon = Lexicon(weights)

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, int]] = []
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
                words = folded_words(text)
                line, found = f" {' '.join(words)} ", set()
                blanks = [m.start() for m in _BLANK.finditer(line)]
                for end, (length, _, _) in lexicon.machine().iter(line) if weights else ():
                    at = bisect_left(blanks, end - length + 2) - 1
                    found.update(f"{words[i]} {words[i + 1]}" for i in (at - 1, at) if 0 <= i < len(words) - 1)
                out += [(p, y) for p in found]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], pa.string()), pa.array([y for _, y in out], pa.int32())], ["phrase", "y"])

    found = sample.mapInArrow(phrases, "phrase string, y int").groupBy("phrase").agg(F.sum("y").alias("toxic"), F.count("y").alias("n"))
    clean = found.where((F.col("toxic") == 0) & (F.col("n") >= min_docs))
    return frozenset(r["phrase"] for r in clean.orderBy(F.desc("n"), "phrase").limit(MAX_ENTRIES).collect())


def _densities(texts: DataFrame, lexicon: Lexicon, keep: str, kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [lexicon.density(folded_words(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(keep), pa.array(found, pa.float64())], [keep, "density"])

    return texts.select(keep, "text").mapInArrow(run, f"{keep} {kind}, density double")


def _calibrated(sample: DataFrame, lexicon: Lexicon) -> Lexicon:
    """The logistic map from density to score, by Newton steps on a histogram of densities."""
    step = 0.05
    bins = _densities(sample, lexicon, "y", "int").groupBy(F.least(F.round(F.col("density") / step), F.lit(2000)).alias("bin")).agg(
        F.sum("y").alias("toxic"), F.count("y").alias("n")
    ).collect()
    x = np.array([b["bin"] * step for b in bins])
    n, y = (np.array([float(b[k]) for b in bins]) for k in ("n", "toxic"))
    design = np.stack([x, np.ones_like(x)])
    beta, ridge = np.zeros(2), np.diag([1e-3, 1e-3]) * max(1.0, n.sum())
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(beta @ design, -30, 30)))
        move = np.linalg.solve((design * (n * p * (1 - p))) @ design.T + ridge, design @ (y - n * p) - ridge @ beta)
        beta = beta + move
        if np.abs(move).max() < 1e-6:
            break
    return Lexicon(lexicon.weights, lexicon.exceptions, float(beta[0]), float(beta[1]))


def score_documents(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(doc_id, density, score), one row per document; null and empty texts have density 0."""
    small_batches(docs.sparkSession)
    found = _densities(id_and_text(docs), lexicon, "doc_id", "long")
    z = F.lit(lexicon.slope) * F.col("density") + F.lit(lexicon.offset)
    return found.select("doc_id", "density", (1 / (1 + F.exp(-z))).alias("score"))


def learn_and_score(docs: DataFrame, labels: DataFrame, folds: int = 5, held_fold: int = 0, threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted, density): learned outside the held-out fold, scored for every document.

    Null ids are not held out and have no label. Repeated rows give repeated results; of labels that repeat
    an id the larger counts. An empty documents table gives an empty result.
    """
    lexicon = learn_lexicon(docs, labels, fold_of(F.col("_label_id"), folds) != held_fold)
    held = F.coalesce(fold_of(F.col("doc_id"), folds) == held_fold, F.lit(False))
    return score_documents(docs, lexicon).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "density"
    )


def keep_clean(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.5) -> DataFrame:
    """Rows whose text scores under the threshold, all columns as given; null texts are clean."""
    small_batches(docs.sparkSession)

    @F.pandas_udf(T.DoubleType())
    def density(texts):
        return texts.fillna("").map(lambda t: lexicon.density(folded_words(t)))

    z = F.lit(lexicon.slope) * density(F.col("text")) + F.lit(lexicon.offset)
    return docs.where(1 / (1 + F.exp(-z)) < threshold)
