"""Language identification by rank-order profiles of character n-grams.

A profile lists the most frequent 1- to 3-grams of a language by rank. A document's own most frequent
n-grams are compared with each profile: the out-of-place distance sums how far each gram's ranks lie
apart, with the most for a gram that the profile lacks. The nearest profile wins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotline.llm.common import drawn, fold_of, id_and_text, small_batches

GRAMS = 300
# bound of the documents that profiles are learned from, spread evenly over all training documents
FIT_DOCS = 20_000
UNDETERMINED = "und"
_NO_LETTER, _BLANKS = re.compile(r"[\W\d_]+"), re.compile(" +")
# numerals that are word characters without being letters, such as superscripts, fractions and Roman numerals
_NUMERALS = frozenset(c for c in map(chr, range(0x110000)) if c.isnumeric() and not c.isalpha() and not c.isdecimal())
# counted at a time, so that a very long text needs bounded memory
WINDOW = 1 << 20
_BITS = 21


def _codes(line: str) -> np.ndarray:
    """1- to 3-grams of a line of words as numbers of 21 bits a character; grams over a word's end are left out.

    A blank counts as a word's edge: it may begin or end a gram, but not stand alone or in the middle.
    """
    c = np.frombuffer(line.encode("utf-32-le"), dtype="<u4").astype(np.int64)
    blank = c == 32
    two = (c[:-1] << _BITS) | c[1:]
    three = (two[:-1] << _BITS) | c[2:]
    return np.concatenate((c[~blank], two, three[~blank[1:-1]]))


def letters_of(text: str) -> str:
    """The letters of a text in lower case, whatever lies between them as one blank."""
    line = _NO_LETTER.sub(" ", text)
    if not line.isascii() and (odd := _NUMERALS.intersection(line)):
        line = _BLANKS.sub(" ", line.translate(dict.fromkeys(map(ord, odd), " ")))
    return line.strip().lower()


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of the letters of a text, in lower case, and how often each occurs."""
    line = letters_of(text)
    if not line:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    line = f" {line} "
    grams, counts = np.unique(_codes(line[:WINDOW]), return_counts=True)
    for at in range(WINDOW, len(line), WINDOW):
        # three characters of overlap would count twice; a gram belongs to the window its last character is in
        more, n = np.unique(_window(line, at), return_counts=True)
        grams, back = np.unique(np.concatenate((grams, more)), return_inverse=True)
        counts = np.bincount(back, weights=np.concatenate((counts, n))).astype(np.int64)
    return grams, counts


def _window(line: str, at: int) -> np.ndarray:
    c = np.frombuffer(line[at - 2 : at + WINDOW].encode("utf-32-le"), dtype="<u4").astype(np.int64)
    blank = c == 32
    two = (c[:-1] << _BITS) | c[1:]
    three = (two[:-1] << _BITS) | c[2:]
    return np.concatenate((c[2:][~blank[2:]], two[1:], three[~blank[1:-1]]))


def top_grams(text: str, size: int) -> np.ndarray:
    """The most frequent grams, most frequent first; ties go to the smaller code."""
    grams, counts = gram_counts(text)
    if len(grams) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        near = counts >= least
        grams, counts = grams[near], counts[near]
    return grams[np.argsort(-counts, kind="stable")][:size]


def learn_profiles(
    docs: DataFrame, train: Column, size: int = GRAMS, fit_docs: int = FIT_DOCS
) -> dict[str, np.ndarray]:
    """Profiles by language from the rows where `train` holds, `lang` is not null and text is there.

    At most about `fit_docs` of these rows are used, shared out evenly over the languages: a language with fewer rows than
    its share gives all of them, a larger one a draw by a hash of the id. The driver gets the languages' row counts and `size`
    grams per language. Without training rows there is no profile.
    """
    known = docs.where(train & docs["lang"].isNotNull() & docs["text"].isNotNull())
    sizes = {r["lang"]: r["n"] for r in known.groupBy(F.col("lang").cast("string").alias("lang")).agg(F.count(F.lit(1)).alias("n")).collect()}
    budget = max(1, fit_docs // max(1, len(sizes)))
    draw, taken = F.xxhash64(F.col("doc_id").cast("string"), F.lit("profile")), F.lit(True)
    for lang, n in sizes.items():
        if n > budget:
            taken = F.when(F.col("lang").cast("string") == lang, drawn(draw, budget, n)).otherwise(taken)
    known = known.where(taken)
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                by_lang.setdefault(lang, []).append(gram_counts(text))
            for lang, found in by_lang.items():
                grams, back = np.unique(np.concatenate([g for g, _ in found]), return_inverse=True)
                n = np.bincount(back, weights=np.concatenate([c for _, c in found]), minlength=len(grams)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n)], ["lang", "gram", "n"]
                )

    counts = known.select(F.col("lang").cast("string"), F.col("text").cast("string")).mapInArrow(
        count, "lang string, gram long, n long"
    ).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = counts.withColumn("rank", rank).where(F.col("rank") <= size).orderBy("lang", "rank").collect()
    profiles: dict[str, list[int]] = {}
    for row in best:
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return {lang: np.array(grams, dtype=np.int64) for lang, grams in profiles.items()}


class Ranks:
    """Ranks of every profiled gram in every language, for distances of many documents."""

    def __init__(self, profiles: dict[str, np.ndarray], size: int):
        self.size, self.langs = size, sorted(profiles)
        self.grams = np.unique(np.concatenate([*profiles.values(), np.empty(0, dtype=np.int64)]))
        self.rank = np.full((len(self.langs), len(self.grams) + 1), -1, dtype=np.int64)
        for i, lang in enumerate(self.langs):
            self.rank[i, np.searchsorted(self.grams, profiles[lang])] = np.arange(len(profiles[lang]))

    def distances(self, grams: np.ndarray) -> np.ndarray:
        """Out-of-place distance of a document's ranked grams to each language."""
        at = np.searchsorted(self.grams, grams)
        at[(at == len(self.grams)) | (self.grams[np.minimum(at, len(self.grams) - 1)] != grams)] = len(self.grams)
        rank = self.rank[:, at]
        return np.where(rank < 0, self.size, np.abs(rank - np.arange(len(grams)))).sum(axis=1)


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], size: int = GRAMS) -> DataFrame:
    """(doc_id, lang_pred, score), one row per document, from the text alone.

    score is 1 minus the share of the largest possible distance. A null text, one without a letter, and any
    text where no profile is known give `und` with score 0. Ties go to the language first by name. Repeated
    rows give repeated results.
    """
    small_batches(docs.sparkSession)
    ranks = Ranks(profiles, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for text in batch.column("text").to_pylist():
                grams = top_grams(text, size) if ranks.langs else ()
                if not len(grams):
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                far = ranks.distances(grams)
                best = int(np.argmin(far))
                langs.append(ranks.langs[best])
                scores.append(1.0 - float(far[best]) / (size * len(grams)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"]
            )

    return id_and_text(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, folds: int = 4, held_fold: int = 2) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): profiles from the folds that are not held out, then every document."""
    profiles = learn_profiles(docs, F.coalesce(fold_of(F.col("doc_id"), folds) != held_fold, F.lit(False)))
    found = predict(docs, profiles)
    held = F.coalesce(fold_of(F.col("doc_id"), folds) == held_fold, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")
