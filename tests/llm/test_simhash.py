import random
import re

import numpy as np
import xxhash
from lotline.llm import simhash
from lotline.llm.common import table

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, max_bits=2):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            root[p] = root[root[p]]
            p = root[p]
        return p

    prints = list(prints)
    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= max_bits:
                root[find(a)] = find(b)
    return {p: find(p) for p in prints}


def expected(rows):
    """rows: (doc_id, fingerprint)."""
    root = plain_components({f for _, f in rows})
    least = {}
    for i, f in rows:
        least[root[f]] = min(i, least.get(root[f], i))
    return {(i, f"{f:016x}", least[root[f]]) for i, f in rows}


def got(df):
    return {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.collect()}


def test_whole_table_equals_brute_force(spark):
    docs = table(spark, SF, "documents")
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in docs.collect()]
    assert got(simhash.near_duplicates(docs)) == expected(rows)


def test_edge_texts(docs_of):
    texts = [None, "", " \t\n", "one", "One", "two words", "é É", "a b c d", "A  b\nc d", "x " * 5000]
    assert got(simhash.near_duplicates(docs_of(texts))) == expected(list(enumerate(map(plain_fingerprint, texts))))


def test_dense_keys_give_the_same_components(spark):
    rng = random.Random(3)
    centre = [rng.getrandbits(64) for _ in range(3)]
    prints = {c ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) & (2**64 - 1) for c in centre for _ in range(150)}
    want = plain_components(prints)
    signed = [(int(np.array(p, dtype=np.uint64).view(np.int64)),) for p in prints]
    df = spark.createDataFrame(signed, "bits long")
    for dense in (4, 10_000):
        edges = [(a % 2**64, b % 2**64) for a, b in simhash.links(df, dense=dense).collect()]
        assert all((a ^ b).bit_count() <= 2 for a, b in edges)
        root = {p: p for p in prints}
        for _ in prints:
            for a, b in edges:
                root[a] = root[b] = min(root[a], root[b])
        assert len({(want[p], root[p]) for p in prints}) == len(set(want.values())) == len(set(root.values()))


def test_every_pair_within_the_distance_shares_a_chain(spark):
    rng = random.Random(5)
    pairs = []
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randrange(1, 3)):
            b ^= 1 << bit
        pairs += [(int(np.array(x, dtype=np.uint64).view(np.int64)),) for x in (a, b)]
    df = spark.createDataFrame(pairs, "bits long").distinct()
    assert simhash.links(df).distinct().count() == 300


def test_keep_one_per_group(docs_of):
    text = "the same words in a row for a test of copies"
    docs = docs_of([(5, text), (2, text), (2, text), (9, "quite another text of some words"), (None, text), (None, "")], extra=("bits", "component_id"))
    kept = simhash.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, -1, 2, 9]


def test_repeated_ids_with_different_texts(docs_of):
    a, b, c = "the same words in a row for a test of copies", "quite another text of some words", "and a third one that nobody else has got here"
    docs = docs_of([(3, a), (5, a), (5, b), (7, b), (5, c), (5, c)], extra=("_nth", "kept"))
    kept = simhash.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == sorted([(3, a), (5, b), (5, c)])


def test_empty_table(docs_of):
    docs = docs_of([(0, "a")]).where("doc_id > 5")
    assert simhash.near_duplicates(docs).collect() == []
    assert simhash.keep_one_per_group(docs).collect() == []
