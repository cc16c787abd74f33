import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from lotline.llm import pitman_yor as py
from lotline.llm.common import table

SF = "/root/testdata/sf0.001"


def stirling(n, d):
    out = {(0, 0): 1.0}
    for c in range(1, n + 1):
        for t in range(1, c + 1):
            out[c, t] = out.get((c - 1, t - 1), 0) + (c - 1 - d * t) * out.get((c - 1, t), 0)
    return out


@pytest.mark.parametrize(("c", "others", "parent"), [(2, 0, 0.5), (3, 40, 0.01), (8, 5, 0.2), (16, 300, 0.02)])
def test_tables_follow_their_conditional_distribution(c, others, parent):
    d, s = 0.8, 1.0
    ways = stirling(c, d)
    want = np.array([math.prod((s + d * (others + i)) * parent for i in range(t)) * ways[c, t] for t in range(1, c + 1)])
    n = 40_000
    got = py.sample_tables(np.full(n, c), np.full(n, others), np.full(n, parent), d, s, np.random.default_rng(c))
    assert np.abs(np.bincount(got, minlength=c + 1)[1:] / n - want / want.sum()).max() < 0.012


@pytest.mark.parametrize(("c", "others", "parent"), [(40, 0, 0.5), (60, 30, 0.05), (500, 5, 0.001), (300, 400, 0.2)])
def test_many_customers_are_seated_as_one_by_one(c, others, parent):
    d, s, rng = 0.8, 1.0, random.Random(c)
    plain = []
    for _ in range(3000):
        t = 1
        for j in range(1, c):
            a = (s + d * (others + t)) * parent
            t += rng.random() * (j - d * t + a) < a
        plain.append(t)
    got = py.sample_tables(np.full(3000, c), np.full(3000, others), np.full(3000, parent), d, s, np.random.default_rng(1))
    assert got.max() <= c and got.mean() == pytest.approx(np.mean(plain), rel=0.06)
    assert got.std() == pytest.approx(np.std(plain), rel=0.2, abs=0.1)


def words(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def plain_counts(rows):
    counts = Counter(w for i, t in rows if not held(i) for w in words(t))
    n, v = sum(counts.values()), len(counts)
    base = lambda t: sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words(t))
    return counts, n, base


class PlainModel:
    """Customer-by-customer Gibbs sampling with every table written out."""

    def __init__(self, rows, sweeps, rng):
        self.rng, self.v = rng, len({w for i, t in rows if not held(i) for w in words(t)})
        self.rest = {}  # context -> word -> list of table sizes; context ("root",) is the parent
        self.customers = [(u, w) for i, t in rows if not held(i) for u, w in zip(["<begin>", *words(t)], words(t))]
        for u, w in self.customers:
            self.add(u, w)
        self.sums, self.samples = [], 0
        for _ in range(sweeps):
            for u, w in self.customers:
                self.remove(u, w)
                self.add(u, w)

    def par(self, u):
        return (py.ROOT_DISCOUNT, py.ROOT_STRENGTH) if u == ("root",) else (py.DISCOUNT, py.STRENGTH)

    def prob(self, u, w):
        d, s = self.par(u)
        dishes = self.rest.get(u, {})
        below = 1 / (self.v + 1) if u == ("root",) else self.prob(("root",), w)
        c, t = (sum(sum(x) for x in dishes.values()), sum(len(x) for x in dishes.values()))
        own = dishes.get(w, [])
        return (sum(own) - d * len(own) + (s + d * t) * below) / (c + s)

    def add(self, u, w):
        d, s = self.par(u)
        dishes = self.rest.setdefault(u, {})
        sizes = dishes.setdefault(w, [])
        t = sum(len(x) for x in dishes.values())
        below = 1 / (self.v + 1) if u == ("root",) else self.prob(("root",), w)
        weights = [x - d for x in sizes] + [(s + d * t) * below]
        k = self.rng.choices(range(len(weights)), weights)[0]
        if k == len(sizes):
            sizes.append(1)
            if u != ("root",):
                self.add(("root",), w)
        else:
            sizes[k] += 1

    def remove(self, u, w):
        sizes = self.rest[u][w]
        k = self.rng.choices(range(len(sizes)), sizes)[0]
        sizes[k] -= 1
        if not sizes[k]:
            del sizes[k]
            if u != ("root",):
                self.remove(("root",), w)


def toy_rows(n=60, seed=2):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(25)]
    rows = []
    for i in range(n):
        w, out = rng.choice(vocabulary), []
        for _ in range(rng.randrange(3, 15)):
            out.append(w)
            w = vocabulary[(int(w[1:]) * 3 + int(rng.paretovariate(1.0))) % 25]
        rows.append((i, " ".join(out)))
    return rows


def test_scores_equal_a_plain_gibbs_sampler(docs_of):
    rows = toy_rows() + [(1000 + i, "never seen w1 words") for i in range(8)]
    got = {r["doc_id"]: r for r in py.score_documents(docs_of(rows)).collect()}
    models = []
    model = PlainModel(rows, 5, random.Random(1))
    want = Counter()
    for _ in range(15):
        for u, w in model.customers:
            model.remove(u, w)
            model.add(u, w)
        for i, t in rows:
            for u, w in zip(["<begin>", *words(t)], words(t)):
                want[i, u, w] += model.prob(u, w) / 15
        models.append(1)
    miss = []
    for i, t in rows:
        plain = sum(math.log10(want[i, u, w] / 1) - math.log10(sum(1 for x in zip(["<begin>", *words(t)], words(t)) if x == (u, w))) for u, w in zip(["<begin>", *words(t)], words(t)))
        miss.append((got[i]["score"] - plain) / len(words(t)))
    assert abs(np.mean(miss)) < 0.02 and np.abs(miss).max() < 0.12


def test_counts_and_base_equal_brute_force(spark):
    docs = table(spark, SF, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    counts, n, base = plain_counts(rows)
    got = {r["doc_id"]: r for r in py.score_documents(docs).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        r, own = got[i], words(t)
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held(i), len(own), n)
        assert r["n_known"] == sum(counts[w] > 0 for w in own) and r["base_score"] == pytest.approx(base(t))
        assert r["score"] < 0 and r["perplexity"] == pytest.approx(10 ** (-r["score"] / len(own)))
    out = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_parent_sums_to_one():
    customers, tables = np.array([5, 1, 9, 0]), np.array([2, 1, 4, 0])
    p = py.parent_probability(customers, tables, customers.sum(), tables.sum(), 4)
    unknown = py.parent_probability(np.array([0]), np.array([0]), customers.sum(), tables.sum(), 4)
    assert p.sum() + unknown[0] == pytest.approx(1)


def test_split_contexts_and_small_batches_keep_the_scores_close(docs_of, monkeypatch):
    rows = toy_rows(150, 5)
    plain = {r["doc_id"]: r["score"] / r["n_tokens"] for r in py.score_documents(docs_of(rows)).collect()}
    monkeypatch.setattr(py, "HELD_TOKENS", 50)
    monkeypatch.setattr(py, "hot_contexts", lambda texts, buckets: np.sort(py.word_hashes(b"w1 w2 w3 w4 w5")))
    split = {r["doc_id"]: r["score"] / r["n_tokens"] for r in py.score_documents(docs_of(rows)).collect()}
    assert split.keys() == plain.keys()
    assert np.mean([split[k] - plain[k] for k in plain]) == pytest.approx(0, abs=0.03)


def test_word_hashes():
    hashes = py.word_hashes("The the  THE\tcat é É".encode()).tolist()
    assert hashes[0] == hashes[1] == hashes[2] != hashes[3] and hashes[4] != hashes[5] and len(hashes) == 6
    assert len(set(py.word_hashes(("x" * 5000 + " " + "x" * 5001).encode()).tolist())) == 2


def test_edge_rows(docs_of):
    rows = [(1, None), (2, ""), (3, "a a a"), (3, "a a a"), (None, "b"), (4, "long " * 60_000)]
    docs = docs_of(rows, extra=("row", "block"))
    got = py.score_documents(docs).collect()
    counts, n, base = plain_counts(rows)
    assert len(got) == 6 and all(r["train_tokens"] == n and np.isfinite(r["score"]) for r in got)
    assert sorted(r["n_tokens"] for r in got) == [1, 1, 2, 4, 4, 60_001]
    assert py.score_documents(docs.where("doc_id > 9")).collect() == []
    only_held = [i for i in range(100) if held(i)][:2]
    lone = py.score_documents(docs_of([(i, "x y") for i in only_held])).collect()
    assert [(r["n_known"], r["train_tokens"], r["base_score"]) for r in lone] == [(0, 0, 0.0)] * 2


def test_many_buckets_and_hot_contexts_equal_a_plain_gibbs_sampler(docs_of, monkeypatch):
    rows = toy_rows(150, 5)
    monkeypatch.setattr(py, "HELD_TOKENS", 200)
    monkeypatch.setattr(py, "hot_contexts", lambda texts, buckets: np.sort(np.append(py.word_hashes(" ".join(f"w{i}" for i in range(25)).encode()), py.BEGIN)))
    got = {r["doc_id"]: r for r in py.score_documents(docs_of(rows), bucket_bytes=800).collect()}
    model, want = PlainModel(rows, 5, random.Random(1)), Counter()
    pairs = {i: list(zip(["<begin>", *words(t)], words(t))) for i, t in rows}
    for _ in range(10):
        for u, w in model.customers:
            model.remove(u, w)
            model.add(u, w)
        for u, w in {p for own in pairs.values() for p in own}:
            want[u, w] += model.prob(u, w) / 10
    miss = [(got[i]["score"] - sum(math.log10(want[p]) for p in own)) / len(own) for i, own in pairs.items()]
    assert abs(np.mean(miss)) < 0.02 and np.abs(miss).max() < 0.12


def test_blocks_give_back_what_was_packed():
    rng = np.random.default_rng(3)
    arrays = [
        np.sort(rng.integers(0, 2**63, 50).astype(np.uint64)), np.array([3, 2**64 - 1, 0, 7], dtype=np.uint64), np.array([], dtype=np.int64),
        np.array([0, 70_000, 5]), np.array([2**40, 1]), np.array([-4, 9]), rng.random(9).astype(np.float32), np.array([], dtype=np.uint64),
    ]
    for before, after in zip(arrays, py.unpack(py.pack(*arrays)), strict=True):
        assert before.tolist() == after.tolist()


def test_rounded_chances_keep_sixteen_bits():
    chance = 10 ** np.random.default_rng(5).uniform(-20, 0, 10_000)
    assert np.abs(py.rounded(chance) / chance - 1).max() < 2.0**-16 * 1.01
    assert py.rounded(np.array([1.0]))[0] == 1


def test_owners_share_out_all_names():
    names = np.unique(np.random.default_rng(4).integers(0, 2**62, 5000).astype(np.uint64))
    for owners in (1, 7):
        parts = py._by_owner(names, owners)
        assert len(parts) == owners and sorted(np.concatenate(parts).tolist()) == list(range(len(names)))
        assert all((np.diff(p) > 0).all() for p in parts)
        # an owner gets the same names whoever sends them
        some = py._by_owner(names[::3], owners)
        assert all(set(names[::3][q].tolist()) <= set(names[p].tolist()) for p, q in zip(parts, some))


def test_a_pair_in_all_documents_is_dealt_once_per_flush():
    held = [(i, 0, py.word_hashes(f"same u{i}".encode())) for i in range(500)]
    blocks = [py.Pairs.of(block) for _, _, kind, block in py._deal(held, 0, np.array([py.BEGIN]), 4) if kind == 0]
    assert sum(len(b.word) for b in blocks) == 1 + 500 + 500
    counts = np.concatenate([b.count for b in blocks])
    assert sorted(counts.tolist())[-1] == 500 and counts.sum() == 1500


def test_hot_contexts_are_counted_over_all_rows(docs_of, monkeypatch):
    monkeypatch.setattr(py, "HELD_TOKENS", 300)
    texts = docs_of([" ".join(f"x{i}_{j}" for j in range(9)) for i in range(2500)] + ["often " * 900])
    hot = py.hot_contexts(texts.select("doc_id", "text"), 10).tolist()
    assert sorted(hot) == sorted([int(py.BEGIN), *py.word_hashes(b"often").tolist()])
