from collections import Counter

import numpy as np
import pytest
from lotline.llm import decontaminate as dc
from lotline.llm.common import table

SF = "/root/testdata/sf0.01"
ITEM = "Which of the seven old harbours lies north of the river mouth? The northern harbour of Alvik near the stone bridge."


def index_of(texts):
    items = [(i, *dc.question_and_answer(t)) for i, t in enumerate(texts)]
    df = Counter(w for _, q, a in items for w in set(q + a))
    mean = np.mean([len(q) if q == a else len(q + a) for _, q, a in items])
    return dc.Index.build(items, df, len(items), mean)


def plain_scores(index, terms):
    """Sum of weights per item, without any pruning."""
    out = Counter()
    for t in terms:
        for place, weight in zip(*index.postings[t]):
            out[place] += weight
    return out


@pytest.mark.parametrize("block", [1, 3, 16])
def test_wand_returns_all_above_the_threshold(monkeypatch, block):
    monkeypatch.setattr(dc, "BLOCK", block)
    rng = np.random.default_rng(block)
    texts = [" ".join(f"w{int(x)}" for x in rng.zipf(1.3, rng.integers(5, 40)) % 200) for _ in range(150)]
    index = index_of(texts)
    assert all(sum(w for _, w in plain_scores(index, index.terms.values()).items()) > 0 for _ in range(1))
    for _ in range(60):
        terms = sorted(rng.choice(len(index.terms), 30, replace=False).tolist())
        for threshold in (0.2, 0.5, 0.8):
            want = {p: s for p, s in plain_scores(index, terms).items() if s >= threshold - 1e-6}
            assert dict(dc.block_max_wand(index, terms, threshold)) == pytest.approx(want)


def plain_leaks(text, items):
    words = dc.words_of(text or "")
    grams = {tuple(words[i:i + 5]) for i in range(len(words) - 4)}
    out = set()
    for item_id, item in items:
        own = dc.words_of(item)
        if len(own) >= 5:
            want = {tuple(own[i:i + 5]) for i in range(len(own) - 4)}
            if len(want & grams) / len(want) >= 0.8:
                out.add(item_id)
    return out


def test_whole_table_equals_brute_force(spark):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    pairs = [(r["item_id"], r["text"]) for r in items.collect()]
    want = {(r["doc_id"], i) for r in docs.collect() for i in plain_leaks(r["text"], pairs)}
    found = dc.find_leaks(docs, items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == want and len(found) == len(want) > 0
    in_parts = dc.find_leaks(docs, items, part_bytes=1500).collect()
    assert sorted(map(tuple, in_parts)) == sorted(map(tuple, found))


def test_planted_cases_and_clean_texts(spark, docs_of):
    filler = "some other words that have nothing to do with it and go on for a while "
    docs = docs_of([
        (1, ITEM), (2, filler * 30 + ITEM.upper() + filler * 30), (3, filler * 40), (4, ITEM.replace("seven", "nine")),
        (5, ITEM.split("?")[0]), (6, " ".join(sorted(ITEM.split()))), (7, None), (8, ""), (9, filler * 20_000 + ITEM), (2, ITEM), (None, ITEM),
    ], extra=("item_id", "score"))
    items = spark.createDataFrame(
        [(10, ITEM), (10, ITEM), (11, "too short"), (12, None), (None, ITEM), (13, ""), (14, "A different item about the height of twelve towers. Ninety metres.")],
        "item_id long, text string")
    found = sorted((r["doc_id"] or -1, r["item_id"]) for r in dc.find_leaks(docs, items).collect())
    assert found == [(-1, 10), (1, 10), (2, 10), (2, 10), (9, 10)] or found == [(-1, 10), (1, 10), (2, 10), (2, 10), (4, 10), (9, 10)]
    kept = dc.keep_clean(docs, items)
    assert kept.columns == docs.columns and {3, 5, 6, 7, 8} <= {r["doc_id"] for r in kept.collect()} <= {3, 4, 5, 6, 7, 8}


def test_empty_tables(spark, docs_of):
    docs = docs_of([(1, ITEM)])
    items = spark.createDataFrame([(10, ITEM)], "item_id long, text string")
    assert dc.find_leaks(docs, items.where("item_id > 99")).collect() == []
    assert dc.find_leaks(docs.where("doc_id > 9"), items).collect() == []
    assert dc.keep_clean(docs, items.where("item_id > 99")).count() == 1


def test_question_and_answer():
    assert dc.question_and_answer("Who is it? It is Ann.") == (["who", "is", "it"], ["it", "is", "ann"])
    assert dc.question_and_answer("One sentence only") == (["one", "sentence", "only"],) * 2


def test_items_without_spaces_and_short_items(spark, docs_of):
    chinese, japanese, thai = "长江是亚洲最长的河流吗？是的，它很长。", "日本で一番高い山は何ですか。富士山です。", "แม่น้ำที่ยาวที่สุดในโลกคือแม่น้ำอะไร"
    filler = "这里有一些完全不同的句子，和题目没有关系。" * 40
    docs = docs_of([
        (1, filler + chinese + filler), (2, japanese), (3, f"some words {thai} and more"), (4, filler), (5, "He said yes. Blue whale!\nThen he left."),
        (6, "a blue whale was seen there"), (7, "Is it so? Yes. Of course"), (8, "blue whale"), (9, "is it so yes"),
    ])
    items = spark.createDataFrame([(10, chinese), (11, japanese), (12, thai), (13, "Blue whale."), (14, "Is it so? Yes."), (15, "..."), (16, "")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in dc.find_leaks(docs, items).collect()}
    assert found == {(1, 10), (2, 11), (3, 12), (5, 13), (8, 13), (7, 14), (9, 14)}
    assert {r["doc_id"] for r in dc.keep_clean(docs, items).collect()} == {4, 6}


def test_bounds_by_windows_of_passages(monkeypatch):
    rng = np.random.default_rng(9)
    index = index_of([" ".join(f"w{int(x)}" for x in rng.zipf(1.3, 20) % 300) for _ in range(200)])
    text = " ".join(f"w{int(x)}" for x in rng.zipf(1.3, 5_000) % 400) + " " + " ".join(list(index.terms)[:20])
    whole = dc.search(index, text, 0.3, 0.1)
    for cells in (1, 1_000, 50_000):
        monkeypatch.setattr(dc, "CELLS", cells)
        assert dc.search(index, text, 0.3, 0.1) == whole
    assert whole
