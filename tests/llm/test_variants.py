import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lotline.llm import variants
from lotline.llm.common import table
from lotline.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain_vocabulary(rows, min_length=6, min_count=5, damage=199):
    seen = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % damage == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= min_length and n >= min_count}


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(words, ratio=5):
    """Near words by what is left when one letter is taken out or masked, checked on the strings."""
    holes = {}
    for w in words:
        for i in range(len(w)):
            holes.setdefault(w[:i] + w[i + 1 :], set()).add(w)
            holes.setdefault(w[:i] + "*" + w[i + 1 :], set()).add(w)
        holes.setdefault(w, set()).add(w)
    near = {w: set() for w in words}
    for group in holes.values():
        for a in group:
            near[a] |= {b for b in group if b not in near[a] and one_apart(a, b)}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda b: (-words[b], b), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words.get(form[w]))
    return out


def result(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def test_query_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    words = plain_vocabulary(rows)
    assert len(words) > 500
    expected = plain_groups(words)
    assert result(QUERIES["op13_spelling_variants"](spark, SF)) == expected
    assert any(v[0] for v in expected.values())


@pytest.mark.parametrize("symbols", [2, 5, 12])
def test_pairs_for_any_number_of_symbols(spark, symbols):
    words = ["abcdef", "abcdeg", "abdcef", "abcde", "aabcdef", "bcdef", "àbcdef", "Àbcdef", "zzzzzz", "zzzzz", "ñandúes", "ñandues", "×÷×÷×÷", "×÷×÷×"]
    found = {tuple(sorted(r)) for r in variants.near_pairs(spark.createDataFrame([(w,) for w in words], "word string"), symbols).collect()}
    assert found == {(a, b) for a in words for b in words if a < b and one_apart(a, b)}


def test_neighbourhood_is_whole(spark):
    got = spark.range(1).select(variants.one_edit_neighbourhood(F.lit("abba"), 3)).head()[0]
    letters = "abc"
    every = {x for n in (3, 4, 5) for x in _strings(letters, n)}
    assert len(got) == len(set(got)) and set(got) == {x for x in every if x == "abba" or one_apart(x, "abba")}


def _strings(letters, n):
    return [""] if n == 0 else [a + b for a in letters for b in _strings(letters, n - 1)]


def test_chains_ties_and_letters_beyond(spark, docs_of):
    text = " ".join(["color" + "s"] * 5 + ["colours"] * 25 + ["colourss"] * 125 + ["harbor"] * 5 + ["harbar"] * 25 + ["harbur"] * 25 + ["STRASSE", "straße"] * 6)
    docs = docs_of([(None, text), (2, None), (3, ""), (3, "")])
    got = result(variants.group_variants(variants.vocabulary(docs, damage=1 << 40)))
    assert got["colors"] == ("colours", "colourss", 5, 1, 25) and got["colours"][1] == "colourss"
    assert got["harbor"] == ("harbar", "harbar", 5, 2, 25)
    assert got["harbur"] == (None, "harbur", 25, 2, None)
    assert got["strasse"] == (None, "strasse", 6, 0, None) and got["straße"][2] == 6


def test_damage_counts_the_short_result(spark):
    runs = [w for w in ("abcdefg%s" % chr(97 + i) for i in range(26))]
    rows = [(i, " ".join(runs)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["word"]: r["n"] for r in variants.vocabulary(docs, damage=7).collect()}
    assert got == plain_vocabulary(rows, damage=7) and any(len(w) == 7 for w in got)


def test_a_hot_word_a_long_text_and_clashing_columns(spark):
    rows = [(i, "veronica veronika") for i in range(300)] + [(300, "veronnica " * 50_000)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int")
    assert result(variants.group_variants(variants.vocabulary(docs))) == plain_groups(plain_vocabulary(rows))


def test_empty_table(spark, docs_of):
    empty = docs_of([(1, "a")]).limit(0)
    assert variants.group_variants(variants.vocabulary(empty)).collect() == []


def test_sql_on_edge_texts(spark):
    import duckdb

    text = " ".join(["garçons"] * 30 + ["garcons", "garçon"] * 6 + ["Ñandúes×÷"] * 9 + ["ÑANDÚES×÷"] * 5)
    frame = spark.createDataFrame([(None, text), (2, None), (3, ""), (-4, text * 3)], "doc_id long, text string")
    documents = frame.toPandas().astype({"doc_id": "Int64"})  # noqa: F841  (read by the SQL)
    want = {r[0]: tuple(r[1:]) for r in duckdb.connect().execute(SQL["op13_spelling_variants"]).fetchall()}
    assert result(variants.group_variants(variants.vocabulary(frame))) == want and len(want) >= 4
