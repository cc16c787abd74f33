import math

import pytest
from lotline.llm import toxicity
from lotline.llm.common import fold_of, table
from lotline.llm.toxicity import Lexicon, folded_words
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.1"


def test_disguised_spellings_fold_to_one_form():
    plain = folded_words("idiot loser")
    assert folded_words("1d10t L0s3r") == plain
    assert folded_words("іdіоt ｌоѕеr") == plain  # Cyrillic and full-width letters
    assert folded_words("“idiot!” (loser)### $$$ 123 --") == plain
    assert folded_words("IDIOT\tLOSER\n") == plain
    assert folded_words("") == [] and folded_words("12 34") == []


def plain_density(weights, exceptions, words):
    total = 0.0
    for i, w in enumerate(words):
        hits = [v for k, v in weights.items() if (w.startswith(k[:-1]) if k.endswith("*") else w == k)]
        near = {" ".join(words[j:j + 2]) for j in (i - 1, i) if 0 <= j < len(words) - 1}
        if hits and not near & exceptions:
            total += max(hits)
    return total / math.log2(2 + len(words)) if words else 0.0


@pytest.mark.parametrize("line", [
    "", "bad", "bad bad bad", "the bad news and badly bad", "not bad at all", "bad", "worse bad not", "abad badx bad bad",
    "not bad not bad bad", "x " * 4000 + "bad", "worse", "worsen worse",
])
def test_density_equals_brute_force(line):
    weights, exceptions = {"bad": 2.0, "wors*": 1.5, "worse": 3.0, "badl*": 4.0}, frozenset({"not bad", "bad news"})
    words = line.split()
    assert toxicity.Lexicon(weights, exceptions).density(words) == pytest.approx(plain_density(weights, exceptions, words))


def test_length_lowers_the_density_of_one_match():
    lexicon = Lexicon({"bad": 2.0})
    assert lexicon.density(["bad"]) > lexicon.density(["bad"] + ["fine"] * 100) > 0


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    found = toxicity.learn_and_score(docs, labels)
    assert found.count() == docs.count()
    seen = found.join(labels, "doc_id").where("held_out").select("toxic", "predicted", "score").collect()
    toxic, clean = [r for r in seen if r["toxic"]], [r for r in seen if not r["toxic"]]
    assert sum(r["predicted"] for r in toxic) / len(toxic) > 0.85
    assert sum(r["predicted"] for r in clean) / len(clean) < 0.01
    assert all(0 <= r["score"] <= 1 for r in seen)


def test_exception_phrases_are_learned(spark):
    rows = [(i, "you are a rotten person today", 1) for i in range(30)] + [(30 + i, "a rotten apple fell down today", 0) for i in range(6)]
    rows += [(40 + i, "a person walks here and there", 0) for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    lexicon = toxicity.learn_lexicon(docs, labels, F.lit(True))
    assert "rotten appie" in lexicon.exceptions
    assert lexicon.score(lexicon.density(folded_words("you are a r0tten person"))) > 0.5
    assert lexicon.score(lexicon.density(folded_words("one rotten apple"))) < 0.5


def test_edge_rows(spark, docs_of):
    docs = docs_of([(1, None), (2, ""), (3, "word"), (3, "word"), (None, "word"), (4, "x" * 200_000)], extra=("score", "toxic"))
    labels = spark.createDataFrame([(1, None), (2, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    rows = toxicity.learn_and_score(docs, labels).collect()
    assert len(rows) == 6 and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in rows)
    assert toxicity.learn_and_score(docs.where("doc_id > 9"), labels).collect() == []
    assert toxicity.learn_and_score(docs, labels.where("doc_id > 9")).count() == 6
    kept = toxicity.keep_clean(docs, Lexicon({"word": 5.0}, slope=3.0, offset=-1.0))
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {1, 2, 4}


def test_training_rows_stay_out_of_the_held_out_fold(spark):
    ids = spark.range(1000).select(F.col("id"), fold_of(F.col("id"), 5).alias("f"))
    import zlib
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in ids.collect())
