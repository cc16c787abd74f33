"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages and carries the only label. Each passage is encoded from surface statistics
and hashed character-class trigrams by a small learned layer; gated attention weights the passages, and a
logistic unit scores the weighted passage representation. The weights are learned from document labels by
rounds of local gradient steps on executors, whose results are averaged.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotline.llm.common import drawn, fold_of, id_and_text, small_batches
from lotline.staging import stage

PASSAGE_WORDS = 64
HIDDEN = 16
GATE = 8
# bound of the labelled documents that the weights are learned from, spread evenly over all of them
FIT_DOCS = 12_000
ROUNDS = 6
EPOCHS = 4
# passages of one document that a step of the fit looks at, spread over it; scores attend to all
FIT_PASSAGES = 128
MIN_STEPS = 60
PARTS = 6
RATE = 0.02
SEED = 11
_CLASSES = 8  # blank, line end, lower, upper, digit, point-like, other sign, beyond ASCII
_GRAMS = _CLASSES**3
_STATS = 6
FEATURES = _GRAMS + _STATS


def _class_table() -> np.ndarray:
    out = np.full(256, 7, dtype=np.uint8)
    out[:128] = 6
    out[[32, 9, 11, 12]] = 0
    out[[10, 13]] = 1
    out[97:123], out[65:91], out[48:58] = 2, 3, 4
    out[[ord(c) for c in ".,;:!?'-"]] = 5
    return out


_CLASS = _class_table()
_MIX = np.random.default_rng(SEED).integers(1, 2**62, 256).astype(np.uint64) | np.uint64(1)
_POWER = np.cumprod(np.full(1 << 12, 0x9E3779B97F4A7C15 | 1, dtype=np.uint64))


def passage_features(text: bytes) -> np.ndarray:
    """One row of features per passage of `PASSAGE_WORDS` words of a UTF-8 text.

    Shares of the character-class trigrams, then: share of words equal to the one before, share of words seen before in
    the passage, mean word length, words in the passage, share of non-letters, and a text with no word at all.
    A text without a word is one passage.
    """
    raw = np.frombuffer(text, dtype=np.uint8)
    kind = _CLASS[raw]
    word = kind > 1
    first = word.copy()
    first[1:] &= ~word[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        row = np.zeros((1, FEATURES), dtype=np.float32)
        row[0, -1] = 1
        return row
    rows = -(-len(starts) // PASSAGE_WORDS)
    bounds = starts[::PASSAGE_WORDS].copy()
    bounds[0] = 0
    sizes = np.diff(np.append(bounds, len(raw)))
    place = np.repeat(np.arange(rows), sizes)
    out = np.zeros((rows, FEATURES), dtype=np.float32)
    if len(raw) > 2:
        code = kind.astype(np.int64)
        gram = code[:-2] * _CLASSES**2 + code[1:-1] * _CLASSES + code[2:]
        out[:, :_GRAMS] = np.bincount(place[:-2] * _GRAMS + gram, minlength=rows * _GRAMS).reshape(rows, _GRAMS) / sizes[:, None]
    owner = np.cumsum(first) - 1
    at = np.arange(len(raw)) - starts[np.maximum(owner, 0)]
    value = np.where(word, _MIX[raw] * _POWER[np.clip(at, 0, len(_POWER) - 1)], np.uint64(0))
    hashed = np.add.reduceat(value, starts)
    group = np.arange(len(starts)) // PASSAGE_WORDS
    count = np.bincount(group, minlength=rows)
    same = np.append(False, hashed[1:] == hashed[:-1])
    order = np.lexsort((hashed, group))
    again = np.append(False, (hashed[order][1:] == hashed[order][:-1]) & (group[order][1:] == group[order][:-1]))
    out[:, _GRAMS] = np.bincount(group, weights=same, minlength=rows) / count
    out[:, _GRAMS + 1] = np.bincount(group[order], weights=again, minlength=rows) / count
    letters = np.bincount(place, weights=word, minlength=rows)
    out[:, _GRAMS + 2] = np.minimum(letters / count / 20, 4)
    out[:, _GRAMS + 3] = count / PASSAGE_WORDS
    out[:, _GRAMS + 4] = np.bincount(place, weights=(kind > 3) & (kind < 7), minlength=rows) / np.maximum(letters, 1)
    return out


def start_weights(rng: np.random.Generator, offset: float) -> dict[str, np.ndarray]:
    """Small random weights; the last unit starts at the log odds of the labels."""
    return {
        "E": rng.normal(0, 0.3, (FEATURES, HIDDEN)), "e": np.zeros(HIDDEN),
        "V": rng.normal(0, 0.3, (HIDDEN, GATE)), "U": rng.normal(0, 0.3, (HIDDEN, GATE)), "w": rng.normal(0, 0.3, GATE),
        "c": rng.normal(0, 0.3, HIDDEN), "b": np.array([offset]),
    }


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def forward(weights: Mapping[str, np.ndarray], rows: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Scores of bags whose passages lie in `rows` from `starts` on, with what the gradient needs."""
    h = np.tanh(rows @ weights["E"] + weights["e"])
    t, s = np.tanh(h @ weights["V"]), _sigmoid(h @ weights["U"])
    a = (t * s) @ weights["w"]
    bag = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(rows))))
    a = np.exp(a - np.maximum.reduceat(a, starts)[bag])
    a /= np.add.reduceat(a, starts)[bag]
    z = np.add.reduceat(a[:, None] * h, starts, axis=0)
    return _sigmoid(z @ weights["c"] + weights["b"]), (h, t, s, a, z, bag)


def gradient(weights: Mapping[str, np.ndarray], rows: np.ndarray, starts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Gradient of the mean log loss of the bags."""
    p, (h, t, s, a, z, bag) = forward(weights, rows, starts)
    miss = (p - y) / len(y)
    dz = miss[:, None] * weights["c"]
    da = (dz[bag] * h).sum(axis=1)
    da = a * (da - np.add.reduceat(a * da, starts)[bag])
    dt, ds = da[:, None] * weights["w"] * s * (1 - t * t), da[:, None] * weights["w"] * t * s * (1 - s)
    dh = (a[:, None] * dz[bag] + dt @ weights["V"].T + ds @ weights["U"].T) * (1 - h * h)
    return {
        "E": rows.T @ dh, "e": dh.sum(axis=0), "V": h.T @ dt, "U": h.T @ ds, "w": (da[:, None] * t * s).sum(axis=0),
        "c": z.T @ miss, "b": np.array([miss.sum()]),
    }


def _take_steps(weights: dict[str, np.ndarray], bags: list[np.ndarray], y: np.ndarray, seed: int) -> dict[str, np.ndarray]:
    """A few epochs of Adam over mini-batches of bags."""
    rng = np.random.default_rng(seed)
    m, v = ({k: np.zeros_like(x) for k, x in weights.items()} for _ in range(2))
    n = 0
    for _ in range(max(EPOCHS, -(-MIN_STEPS * 64 // len(bags)))):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), 64):
            part = order[at : at + 64]
            rows = np.concatenate([bags[i] for i in part]).astype(np.float64)
            starts = np.concatenate(([0], np.cumsum([len(bags[i]) for i in part])[:-1]))
            n += 1
            for k, g in gradient(weights, rows, starts, y[part]).items():
                g = g + 1e-4 * weights[k]
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                weights[k] = weights[k] - RATE * (m[k] / (1 - 0.9**n)) / (np.sqrt(v[k] / (1 - 0.999**n)) + 1e-8)
    return weights


def _pack(weights: Mapping[str, np.ndarray]) -> list[float]:
    return np.concatenate([weights[k].ravel() for k in sorted(weights)]).tolist()


def _unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    like = start_weights(np.random.default_rng(0), 0.0)
    out, at = {}, 0
    for k in sorted(like):
        out[k] = np.asarray(flat[at : at + like[k].size], dtype=np.float64).reshape(like[k].shape)
        at += like[k].size
    return out


def learn(docs: DataFrame, labels: DataFrame, train: Column, fit_docs: int = FIT_DOCS, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """Weights from labelled documents; `train` is a condition on `_label_id`.

    At most about `fit_docs` documents are used, spread evenly by a hash of the id, and of a very long document
    in the sample at most `FIT_PASSAGES` passages per step, spread over it. They lie in one staged table of features; every
    round each of `PARTS` tasks starts from the same weights and returns its own. Without labels
    of both kinds the weights score every document alike.
    """
    small_batches(docs.sparkSession)
    known = labels.where("quality is not null").groupBy(F.col("doc_id").alias("_label_id")).agg(F.min("quality").cast("int").alias("y"))
    known = known.where(train)
    known = known.where(drawn(F.xxhash64("_label_id", F.lit("quality")), fit_docs, known.count()))
    texts = id_and_text(docs)
    sample = texts.join(F.broadcast(known), texts["doc_id"] == known["_label_id"]).select("doc_id", "y", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = []
            for text in batch.column("text").to_pylist():
                rows = passage_features(text.encode())
                bags.append(rows[np.linspace(0, len(rows) - 1, min(len(rows), FIT_PASSAGES)).astype(int)].astype(np.float16).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("y"), pa.array(bags, pa.binary())], ["doc_id", "y", "bag"])

    spread = sample.mapInArrow(encode, "doc_id long, y int, bag binary").withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(PARTS)).cast("int"))
    bags = stage(spread.repartition(PARTS, "part"), "bags")
    total = bags.agg(F.sum("y").alias("good"), F.count("y").alias("n")).head()
    good, n = total["good"] or 0, total["n"]
    weights = start_weights(np.random.default_rng(SEED), float(np.log((good + 0.5) / (n - good + 0.5))))
    if not 0 < good < n:
        return weights | {"c": np.zeros(HIDDEN)}
    flat = _pack(weights)
    for step in range(rounds):
        results = bags.groupBy("part").applyInPandas(_local_steps(flat, step), "part int, n long, flat array<double>").collect()
        flat = np.average([r["flat"] for r in results], axis=0, weights=[r["n"] for r in results]).tolist()
    return _unpack(np.array(flat))


def _local_steps(flat: list[float], seed: int):
    """The steps that one part of the bags takes from shared weights."""

    def local(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("doc_id")
        own = [np.frombuffer(b, dtype=np.float16).reshape(-1, FEATURES) for b in part["bag"]]
        found = _take_steps(_unpack(np.array(flat)), own, part["y"].to_numpy(dtype=np.float64), seed)
        return pd.DataFrame({"part": part["part"].iloc[:1], "n": [len(own)], "flat": [_pack(found)]})

    return local


def _score(weights: Mapping[str, np.ndarray], text: bytes, chunk: int = 1 << 22) -> float:
    """Score of one text; features are made piece by piece of about `chunk` bytes, and all passages are attended to."""
    h, at = [], 0
    while at == 0 or at < len(text):
        end = len(text) if len(text) - at <= chunk else text.rfind(b" ", at, at + chunk) + 1
        end = end if end > at else min(len(text), at + chunk)
        h.append(passage_features(text[at:end]))
        at = max(end, 1)
    rows = np.concatenate(h) if len(h) > 1 else h[0]
    return float(forward(weights, rows, np.array([0]))[0][0])


def score_documents(docs: DataFrame, weights: Mapping[str, np.ndarray]) -> DataFrame:
    """(doc_id, score), one row per document; a null or empty text is a bag with one empty passage."""
    small_batches(docs.sparkSession)
    weights = {k: v.astype(np.float32) for k, v in weights.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([_score(weights, t) for t in texts], pa.float64())], ["doc_id", "score"]
            )

    return id_and_text(docs).mapInArrow(run, "doc_id long, score double")


def learn_and_score(docs: DataFrame, labels: DataFrame, folds: int = 5, held_fold: int = 0, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted): learned outside the held-out fold, scored for every document.

    Null ids are not held out and have no label. Repeated rows give repeated results; of labels that
    repeat an id the smaller counts. An empty documents table gives an empty result.
    """
    weights = learn(docs, labels, fold_of(F.col("_label_id"), folds) != held_fold)
    held = F.coalesce(fold_of(F.col("doc_id"), folds) == held_fold, F.lit(False))
    return score_documents(docs, weights).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, weights: Mapping[str, np.ndarray], threshold: float = 0.3) -> DataFrame:
    """Rows whose text scores at the threshold or above, all columns as given; a null text is scored as an empty one."""
    small_batches(docs.sparkSession)
    weights = {k: v.astype(np.float32) for k, v in weights.items()}

    @F.pandas_udf(T.DoubleType())
    def score(texts):
        return texts.fillna("").map(lambda t: _score(weights, t.encode()))

    return docs.where(score(F.col("text")) >= threshold)
