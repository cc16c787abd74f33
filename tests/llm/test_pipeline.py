import hashlib

import corpus_pipeline
from lotline.llm import bpe, decontaminate, quality, simhash, toxicity
from lotline.llm.common import fold_of, table
from pyspark.sql import functions as F
from test_decontaminate import plain_leaks
from test_simhash import expected, plain_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages_equal_their_operators_and_brute_force(spark):
    docs = table(spark, SF, "documents").cache()
    columns, seen = docs.columns, {}
    for name, step in corpus_pipeline.STAGES:
        before = docs
        docs = step(spark, docs, SF).cache()
        seen[name] = (before, docs)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
            assert docs.count() <= before.count()
    ids = {name: ({r["doc_id"] for r in a.select("doc_id").collect()}, {r["doc_id"] for r in b.select("doc_id").collect()}) for name, (a, b) in seen.items()}
    labels = table(spark, SF, "labels")

    before, kept = ids["quality_classifier"]
    scored = quality.learn_and_score(seen["quality_classifier"][0], labels).collect()
    assert kept == {r["doc_id"] for r in scored if r["predicted"]}
    scored = toxicity.learn_and_score(seen["toxicity"][0], labels).collect()
    assert ids["toxicity"][1] == {r["doc_id"] for r in scored if not r["predicted"]}

    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in seen["simhash_near_dedup"][0].collect()]
    assert ids["simhash_near_dedup"][1] == {i for i, _, least in expected(rows) if i == least}

    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    clean = {r["doc_id"] for r in seen["benchmark_decontamination"][0].collect() if not plain_leaks(r["text"], items)}
    assert ids["benchmark_decontamination"][1] == clean

    texts = {r["doc_id"]: r["text"] for r in seen["byte_bpe"][0].collect()}
    final = seen["byte_bpe"][1].collect()
    assert {r["doc_id"] for r in final} == clean == set(texts)
    path = bpe.public_tokenizers.path(bpe.RANKS)
    assert all(bpe.decode(r["ids"], path) == texts[r["doc_id"]].encode() for r in final)
    assert all(r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest() for r in final)


def test_stage_list():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "toxicity", "simhash_near_dedup", "benchmark_decontamination", "byte_bpe"]
    assert corpus_pipeline.ORACLE_SQL is None
    assert all(m is not None for m in (decontaminate, simhash, fold_of, F))
