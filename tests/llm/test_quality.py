import numpy as np
import pytest
from lotline.llm import quality
from lotline.llm.common import fold_of, table
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def test_gradient_equals_finite_differences():
    rng = np.random.default_rng(2)
    weights = quality.start_weights(rng, 0.3)
    rows, starts, y = rng.random((9, quality.FEATURES)), np.array([0, 1, 5]), np.array([1.0, 0.0, 1.0])

    def loss():
        p, _ = quality.forward(weights, rows, starts)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    found = quality.gradient(weights, rows, starts, y)
    for name, value in weights.items():
        flat, g = value.reshape(-1), found[name].reshape(-1)
        for i in rng.integers(0, flat.size, 4):
            old = flat[i]
            flat[i] = old + 1e-6
            up = loss()
            flat[i] = old - 1e-6
            down = loss()
            flat[i] = old
            assert g[i] == pytest.approx((up - down) / 2e-6, abs=1e-6)


def test_attention_weights_sum_to_one_per_document():
    rng = np.random.default_rng(3)
    _, (_, _, _, a, _, bag) = quality.forward(quality.start_weights(rng, 0), rng.random((7, quality.FEATURES)), np.array([0, 3]))
    assert np.bincount(bag, weights=a) == pytest.approx([1, 1])


def plain_features(text):
    words, kinds = text.split(), quality._CLASS[np.frombuffer(text.encode(), dtype=np.uint8)]
    return len(words), np.bincount(kinds, minlength=8)


@pytest.mark.parametrize("text", ["", "  \n ", "one", "two  words", "a b " * 200, "été " * 70, "x" * 9000])
def test_passages(text):
    rows = quality.passage_features(text.encode())
    n, _ = plain_features(text)
    assert rows.shape == (max(1, -(-n // quality.PASSAGE_WORDS)), quality.FEATURES) and np.isfinite(rows).all()
    if n:
        repeats = rows[:, quality._GRAMS + 1]
        for i, r in enumerate(repeats):
            part = text.split()[i * 64:(i + 1) * 64]
            assert r == pytest.approx(1 - len(set(part)) / len(part))


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    found = quality.learn_and_score(docs, labels)
    assert found.count() == docs.count()
    seen = found.join(labels, "doc_id").where("held_out").collect()
    good, bad = ([r["score"] for r in seen if r["quality"] == k] for k in (1, 0))
    assert np.mean(np.array(good)[:, None] > np.array(bad)[None]) > 0.97
    assert np.mean([r["predicted"] == r["quality"] for r in seen]) > 0.94


def test_edge_rows(spark, docs_of):
    docs = docs_of([(1, None), (2, ""), (3, "word"), (3, "word"), (None, "word"), (4, "x y " * 100_000)], extra=("score", "y"))
    labels = spark.createDataFrame([(1, None), (2, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    rows = quality.learn_and_score(docs, labels).collect()
    assert len(rows) == 6 and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2)}) == 1
    assert quality.learn_and_score(docs.where("doc_id > 9"), labels).collect() == []
    weights = quality.learn(docs, labels.where("doc_id > 9"), fold_of(F.col("_label_id"), 5) != 0)
    kept = quality.keep_good(docs, weights, threshold=0.3)
    assert kept.columns == docs.columns and kept.count() == 6


def test_long_texts_are_scored_in_chunks():
    weights = quality.start_weights(np.random.default_rng(1), 0.0)
    text = ("some words of a text " * 300).encode()
    rows = quality._score(weights, text, chunk=len("some words of a text ") * 64)
    assert 0 <= rows <= 1
