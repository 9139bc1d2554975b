"""Texts far longer than any of the driver's tables, and rows that are all alike."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from corpuskit.llm import mixing, packing, secret_scan, token_scan

WORDS = 400_000
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def long(spark):
    key = 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" '
    text = " ".join(f"word{k % 9973}" for k in range(WORDS)) + " " + key * 300
    rows = [(1, text, "en", "a/x", len(text)), (2, "only a short line of words here", "en", "b/y", 30), (3, None, None, None, None)]
    return spark.createDataFrame(rows, COLUMNS)


def test_mixing(long):
    taken = mixing.mix(mixing.with_levels(long), mixing.LEVELS, "n_tokens", fraction=1.0, max_epochs=1).collect()
    assert {r.doc_id: r.take_tokens for r in taken} == {1: WORDS + 900, 2: 7}


def test_secrets(long):
    got = {r.doc_id: r for r in secret_scan.digest(secret_scan.scan_secrets(long)).collect()}
    assert (got[1].n_assign, got[1].n_hex, got[2].spans, got[3].spans) == (300, 300, "", "")
    text = long.where("doc_id = 1").first().text
    want = [("assign", m.start(), m.end() - 1) for m in re.finditer(r'token = "[0-9a-f]{40}"', text)] + [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]{16,}", text)]
    assert got[1].spans == ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(want, key=lambda x: x[1]))


def test_owner_column(spark):
    key = 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"'
    docs = spark.createDataFrame([(k, key, f"repo{k}", "one") for k in range(5)], "doc_id bigint, text string, source string, holder string")
    verdicts = lambda **owner: {s.verdict for r in secret_scan.scan_secrets(docs, **owner).collect() for s in r.spans}
    assert verdicts() == {"example"}  # a source without a slash is its own owner
    assert verdicts(owner="holder") == {"live"}


def test_tokens(long):
    got = {r.doc_id: r.n_tokens for r in token_scan.count_tokens(long).collect()}
    encode = token_scan.tokenizer(token_scan.VOCABULARY).encode_ordinary
    assert got == {r.doc_id: len(encode(r.text or "")) for r in long.collect()}


def test_packing_deals_pieces_and_repeated_rows(long, spark):
    got = packing.pack_documents(packing.with_keys(long), "n_tokens", "source", "cluster", shard_items=20).collect()
    assert sum(r.n_tokens for r in got if r.doc_id == 1) == WORDS + 900
    assert max(Counter(r.shard for r in got).values()) < 60
    alike = spark.createDataFrame([(None, None, "en", "s", None)] * 500 + [(7, "a b c", "en", "s", 5)] * 500, COLUMNS)
    got = packing.pack_documents(packing.with_keys(alike), "n_tokens", "source", "cluster", shard_items=100).collect()
    assert len(got) == 1000 and max(Counter(r.shard for r in got).values()) < 200
    bins = Counter((r.shard, r.bin) for r in got if r.doc_id == 7)
    assert set(bins.values()) == {1}  # copies of each other


def test_domains_by_table(long):
    rows = {r.doc_id: r.domain for r in mixing.with_levels(long, {"a/x": "books"}).collect()}
    assert rows == {1: "books", 2: None, 3: None}


def test_pipeline(long, spark):
    for name, stage in corpus_pipeline.STAGES:
        out = {r.doc_id for r in stage(spark, long, "").collect()}
        want = {"language_id": {1, 2}, "near_dedup": {1, 2, 3}, "secrets": {2, 3}, "packing": {1, 2, 3}}.get(name)
        assert want is None or out == want, name
