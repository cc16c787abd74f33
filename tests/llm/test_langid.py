import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from lotline.llm import langid
from lotline.llm.common import table

SF = "/root/testdata/sf0.01"


def plain_counts(text):
    words = re.sub(r"[\W\d_]+", " ", text or "").strip().lower().split(" ")
    out = Counter()
    for w in filter(None, words):
        padded = f" {w} "
        out.update(w)
        for n in (2, 3):
            out.update(padded[i:i + n] for i in range(len(padded) - n + 1))
    return out


def code(gram):
    out = 0
    for ch in gram:
        out = out << 21 | ord(ch)
    return out


def test_counts_equal_brute_force():
    for text in ("", "a", "One, two; one!", "été à la 東京 x2y", "word " * 500, "ab cd efg " * 150_000):
        grams, counts = langid.gram_counts(text)
        assert dict(zip(grams.tolist(), counts.tolist())) == {code(g): n for g, n in plain_counts(text).items()}


def test_windows_do_not_change_the_counts(monkeypatch):
    text = "Some words of a text, été " * 20
    whole = langid.gram_counts(text)
    monkeypatch.setattr(langid, "WINDOW", 7)
    cut = langid.gram_counts(text)
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()


def test_profiles_distances_and_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    rows = docs.select("doc_id", "text", "lang").collect()
    train = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2]
    want = {}
    for lang in {r["lang"] for r in train}:
        total = Counter()
        for r in train:
            if r["lang"] == lang:
                total += plain_counts(r["text"])
        want[lang] = [code(g) for g, _ in sorted(total.items(), key=lambda x: (-x[1], code(x[0])))[:300]]
    found = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    assert len(found) == len(rows)
    right = held = 0
    for r in rows:
        mine = sorted(((-n, code(g)) for g, n in plain_counts(r["text"]).items()))[:300]
        place = {g: i for i, (_, g) in enumerate(mine)}
        far = {
            lang: sum(abs(i - best.index(g)) if g in best else 300 for g, i in place.items()) for lang, best in want.items()
        } if r["doc_id"] % 20 == 0 else None
        got = found[r["doc_id"]]
        if far:
            assert got["lang_pred"] == min(far, key=lambda k: (far[k], k))
            assert abs(got["score"] - (1 - min(far.values()) / (300 * len(place)))) < 1e-9
        assert got["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        if got["held_out"]:
            held += 1
            right += got["lang_pred"] == r["lang"]
    assert right / held > 0.97


def test_edge_rows(docs_of):
    docs = docs_of([(1, None), (2, ""), (3, "12 + 3"), (4, "the words"), (4, "the words"), (None, "the words")], extra=("gram", "rank"))
    got = {(r["doc_id"], r["lang_pred"]) for r in langid.identify(docs).collect()}
    assert got == {(1, "und"), (2, "und"), (3, "und"), (4, "en"), (None, "en")}
    assert langid.identify(docs).count() == 6
    assert langid.identify(docs.where("doc_id > 9")).collect() == []
    assert {r["lang_pred"] for r in langid.predict(docs, {}).collect()} == {"und"}


def test_numerals_are_no_letters(spark, docs_of):
    docs = docs_of([(0, "²"), (1, "½ Ⅷ 12 ①"), (2, "a²")])
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs, {"en": langid.top_grams("a an the", 300)}).collect()}
    assert got == {0: "und", 1: "und", 2: "en"}
    assert len(langid.gram_counts("x½y")[0]) == len(langid.gram_counts("x y")[0])


def test_a_small_language_keeps_its_rows(spark):
    rows = [(i, "and the of to in is that it", "en") for i in range(3_000)] + [(5_000 + i, "żółć gęś jaźń łódź", "pl") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = langid.learn_profiles(docs, F.lit(True), fit_docs=100)
    assert set(profiles) == {"en", "pl"}
    assert {r["lang_pred"] for r in langid.predict(docs.where("lang = 'pl'"), profiles).collect()} == {"pl"}
