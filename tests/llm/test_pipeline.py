import corpus_pipeline
from tests.llm.test_near_copies import brute_kept
from tests.llm.test_scans import secrets

from corpuskit.llm import mixing, packing, secret_scan

SF = "/root/testdata/sf0.01"
STAGE = dict(corpus_pipeline.STAGES)


def test_stages_on_documents(spark, documents):
    columns = documents.columns
    docs = STAGE["language_id"](spark, documents, SF).cache()
    assert docs.columns == columns
    assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in documents.collect() if any(c.isalpha() for c in r.text)}

    kept = STAGE["near_dedup"](spark, docs, SF).cache()
    rows = docs.collect()
    assert kept.columns == columns
    assert sorted(r.doc_id for r in kept.collect()) == brute_kept([(r.doc_id, r.text) for r in rows])

    clean = STAGE["secrets"](spark, kept, SF).cache()
    assert clean.columns == columns
    verdicts = {r.hash: r.verdict for r in secret_scan.ownership(secret_scan.candidates(kept)).collect()}
    live = {r.doc_id for r in secret_scan.scan_secrets(kept).collect() if any(verdicts[s.hash] == "live" for s in r.spans)}
    ids = {r.doc_id for r in kept.collect()}
    assert live and {r.doc_id for r in clean.collect()} == ids - live
    assert {r.doc_id for r in kept.collect() if not secrets(r.text)[4]} <= {r.doc_id for r in clean.collect()}

    mixed = STAGE["mixing"](spark, clean, SF).cache()
    assert mixed.columns == columns
    assert {tuple(r) for r in mixed.collect()} <= {tuple(r) for r in clean.collect()}
    there = sum(r.n_tokens for r in mixing.with_levels(clean).collect())
    taken = sum(r.n_tokens for r in mixing.with_levels(mixed).collect())
    assert 0.8 * there - 1 <= taken < 0.95 * there

    packed = STAGE["packing"](spark, mixed, SF).collect()
    want = {r.doc_id: r.n_tokens for r in packing.with_keys(mixed).collect()}
    got = {}
    for r in packed:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.n_tokens
    assert got == want
    assert {(r.doc_id, r.piece) for r in packed} == {(r.doc_id, r.piece) for r in corpus_pipeline.run(spark, SF).collect()}


def test_stages_on_odd_and_empty_tables(spark, odd, none, documents):
    extra = odd.withColumnsRenamed({"n_words": "fp", "spans": "row"}).withColumn("n_chars", odd.doc_id)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, extra, SF)
        out.collect()
        if name != "packing":
            assert out.columns == extra.columns, name
        assert stage(spark, none, SF).count() == 0, name


def test_one_of_equal_rows_stays(spark):
    rows = [(1, "a b c d e f", "en", "s", 11)] * 3 + [(None, "a b c d e f", "en", "s", 11)] + [(None, "q r s t u v w", "en", "s", 13)] * 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = STAGE["near_dedup"](spark, docs, SF).collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == [("1", "a b c d e f"), ("None", "q r s t u v w")]
