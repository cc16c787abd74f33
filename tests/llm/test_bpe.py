import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from lotline.llm import bpe
from lotline.llm.common import table

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(bpe.RANKS)
TEXTS = [
    None, "", " ", "\n\n  x", "it's  we'll\tI'D", "naïve café — 東京 🙂🙂 ‍", "<|endoftext|> is plain text", "12345 67,8",
    "a" * 3000, "ab cd " * 60_000, "é x\r\n", "\x00\x01 �", "a\x1cb \x1f\x85c", "   \n trailing   ",
]


@pytest.fixture(scope="module")
def own():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def check(rows, texts, own):
    for r in rows:
        text = texts[r["doc_id"]] or ""
        ids = own.encode_ordinary(text)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_whole_table_equals_another_library(spark, own):
    docs = table(spark, SF, "documents")
    rows = bpe.round_trip_digests(docs).collect()
    assert len(rows) == docs.count()
    check(rows, {r["doc_id"]: r["text"] for r in docs.collect()}, own)


def test_edge_texts(docs_of, own):
    rows = bpe.round_trip_digests(docs_of(TEXTS, extra=("ids", "n_tokens"))).collect()
    assert len(rows) == len(TEXTS)
    check(rows, TEXTS, own)


def test_encode_then_decode_with_spans(docs_of, own):
    docs = docs_of(TEXTS)
    encoded = bpe.encode_documents(docs)
    for r in encoded.collect():
        text = TEXTS[r["doc_id"]] or ""
        assert r["ids"] == own.encode_ordinary(text)
        for i, a, b in zip(r["ids"][:50], r["starts"], r["ends"]):
            piece = own.decode_single_token_bytes(i)
            assert piece in text[a:b].encode()
    back = {r["doc_id"]: r for r in bpe.decode_documents(encoded).collect()}
    assert all(bytes(back[i]["bytes"]) == (t or "").encode() and back[i]["text"] == (t or "") for i, t in enumerate(TEXTS))


def test_spans_cover_whole_texts(spark, docs_of):
    for docs in (docs_of(TEXTS), table(spark, SF, "documents")):
        texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
        for r in bpe.encode_documents(docs).collect():
            text, starts, ends = texts[r["doc_id"]], r["starts"], r["ends"]
            assert len(starts) == len(ends) == len(r["ids"])
            assert not text if not starts else starts[0] == 0 and ends[-1] == len(text) and all(a <= b for a, b in zip(starts[1:], ends))


@pytest.mark.parametrize("room", [1, 7, 100])
def test_a_small_memory_gives_the_same_ids(own, room):
    encode = bpe.Encoder(PATH, room)
    texts = [t or "" for t in TEXTS if len(t or "") < 5000] + ["the cat and the dog " * 20, "a rare word, then the cat again"]
    for _ in range(2):
        assert encode(texts) == [own.encode_ordinary(t) for t in texts]


def test_split_character_is_whole_after_decoding(own):
    ids = own.encode_ordinary("🙂")
    assert len(ids) > 1 and bpe.decode(ids, PATH) == "🙂".encode()
    starts, ends = bpe.char_spans("🙂", ids, PATH)
    assert set(starts) == {0} and set(ends) == {1}


def test_pieces_do_not_change_the_ids(own):
    text = "some words  and\n\nlines, it's 12 don't — " * 50
    assert "".join(list(bpe.pieces(text, 37))) == text
    assert [i for p in bpe.pieces(text, 37) for i in own.encode_ordinary(p)] == own.encode_ordinary(text)


def test_empty_table(docs_of):
    assert bpe.round_trip_digests(docs_of([(0, "a")]).where("doc_id > 5")).collect() == []
