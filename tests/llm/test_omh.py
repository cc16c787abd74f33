import hashlib
import random

import numpy as np
import pytest
from lotline.llm import omh
from lotline.llm.common import table

SF = "/root/testdata/sf0.001"


def plain_signature(text):
    """Order MinHash written out: number the k-mers, take the smallest under each function, keep text order."""
    tokens = []
    for word in text.encode().split():
        tokens += [word[i:i + omh.TOKEN_BYTES] for i in range(0, len(word), omh.TOKEN_BYTES)]
    if not tokens:
        return [0] * omh.SIZE
    one = [int(omh.token_hashes(t)[0]) for t in tokens]
    width = min(omh.K, len(one))
    seen, grams = {}, []
    for i in range(len(one) - width + 1):
        h = 0
        for x in one[i:i + width]:
            h = int(omh._mix(np.array([(h * 0x9E3779B97F4A7C15 + x) % 2**64], dtype=np.uint64))[0])
        n = seen[h] = seen.get(h, -1) + 1
        grams.append(int(omh._mix(np.array([(h + n * 0xD6E8FEB86659FD93) % 2**64], dtype=np.uint64))[0]))
    out = []
    for a, b in omh._SEEDS.tolist():
        ranked = sorted(range(len(grams)), key=lambda i: (((grams[i] >> 32) ^ a) * b % 2**32, i))[:omh.ELL]
        h = 0
        for i in sorted(ranked):
            h = int(omh._mix(np.array([(h * 0x9E3779B97F4A7C15 + grams[i] + 1) % 2**64], dtype=np.uint64))[0])
        out.append(h >> 32)
    return out


TEXTS = ["", " \n ", "one", "two words", "a b a b a b", "x" * 100, "été à la plage " * 9, "the same the same the same thing"]


@pytest.mark.parametrize("text", TEXTS)
def test_signature_equals_brute_force(text):
    assert omh.signature(text.encode()).tolist() == plain_signature(text)


def test_chunks_do_not_change_the_signature(monkeypatch):
    text = " ".join(random.Random(1).choice("abcdefgh") * 3 for _ in range(500)).encode()
    whole = omh.signature(text)
    monkeypatch.setattr(omh, "CHUNK", 64)
    assert (omh.signature(text) == whole).all()


def test_order_and_edits_lower_the_likeness():
    rng = random.Random(4)
    words = [f"w{rng.randrange(400)}" for _ in range(300)]
    base = omh.signature(" ".join(words).encode())
    swapped = omh.signature(" ".join(words[150:] + words[:150]).encode())
    few = words[:]
    few[40] = "changed"
    many = [w if i % 6 else "changed" for i, w in enumerate(words)]
    few, many = (omh.likeness(base, omh.signature(" ".join(w).encode())) for w in (few, many))
    assert 1 > few > many and omh.likeness(base, swapped) < 0.75 and few > 0.9
    assert omh.likeness(base, omh.signature(b"nothing in common here at all")) == 0


def check(rows, docs):
    """docs: (doc_id, text) with distinct ids."""
    docs = sorted(((i, t or "") for i, t in docs), key=lambda x: -x[0])
    by_id = {r["doc_id"]: r for r in rows}
    assert len(by_id) == len(docs) == len(rows)
    for (i, text), (_, after) in zip(docs, docs[1:] + docs[:1]):
        r, half = by_id[i], len(text) // 2
        changed = text[:len(text) - half] + after[:half]
        own, new, other = (omh.signature(t.encode()) for t in (text, changed, after))
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert (r["fingerprint"], r["edited_fingerprint"]) == (omh.fingerprint_text(own), omh.fingerprint_text(new))
        assert (r["near_edited"], r["near_next"]) == (omh.likeness(own, new), omh.likeness(own, other))


@pytest.mark.parametrize("part_bytes", [omh.PART_BYTES, 20_000])
def test_whole_table_equals_brute_force(spark, part_bytes):
    docs = table(spark, SF, "documents")
    check(omh.compare_with_edits(docs, part_bytes).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_uneven_ids_and_many_ranges(spark, docs_of, monkeypatch):
    monkeypatch.setattr(omh, "CELLS", 3)
    ids = [0, 1, 2, 3, 5, 8, 10**6, 10**6 + 1, 10**12, -7]
    rows = [(i, f"text of number {i} with some words " * 3) for i in ids]
    check(omh.compare_with_edits(docs_of(rows), 40).collect(), rows)


def test_edge_rows(docs_of):
    rows = [(5, None), (4, ""), (3, "é"), (2, "two words"), (1, "🙂🙂🙂 x"), (0, "last text of all")]
    check(omh.compare_with_edits(docs_of(rows, extra=("part", "mark"))).collect(), rows)
    check(omh.compare_with_edits(docs_of(rows), 1).collect(), rows)
    check(omh.compare_with_edits(docs_of([(7, "alone here")])).collect(), [(7, "alone here")])
    repeated = [(2, "a b c"), (2, "a b c"), (None, "x y"), (None, None), (1, "z")]
    for size in (1, 10**6):
        assert omh.compare_with_edits(docs_of(repeated), size).count() == 5
    assert omh.compare_with_edits(docs_of(rows).where("doc_id > 9")).collect() == []
    prints = {r["fingerprint"] for r in omh.fingerprints(docs_of([(1, "same text"), (2, "same text")])).collect()}
    assert len(prints) == 1
