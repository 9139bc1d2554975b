import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuskit.llm import language_id as L


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = L.op4_language_id(spark, "/root/testdata/sf0.1").join(docs.select("doc_id", "lang", "text"), "doc_id").where("held_out").collect()
    assert len(got) > 3000
    assert sum(r.lang_pred == r.lang for r in got) / len(got) > 0.99
    assert all(0 <= r.score <= 1 for r in got)


def test_held_out_rule_and_blind_columns(spark, documents):
    model = L.fit(documents, ~L.held_out())
    shuffled = documents.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("y")).withColumn("doc_id", F.col("doc_id") + 7)
    a = {r.doc_id: (r.lang_pred, r.score) for r in L.identify(documents, model).collect()}
    b = {r.doc_id - 7: (r.lang_pred, r.score) for r in L.identify(shuffled, model).collect()}
    assert a == b
    blind = documents.withColumn("lang", F.when(L.held_out(), "zz").otherwise(F.col("lang")))
    assert "zz" not in L.fit(blind, ~L.held_out()).languages


def test_odd_rows(spark, odd, none, documents):
    model = L.fit(documents, ~L.held_out())
    got = L.identify(odd, model).collect()
    texts = [r.text for r in odd.collect()]
    assert len(got) == len(texts)
    assert sum(r.lang_pred == "und" for r in got) == sum(not any(c.isalpha() for c in t or "") for t in texts)
    assert all((r.score == 0) == (r.lang_pred == "und") for r in got)
    assert L.identify(none, model).count() == 0
    empty = L.fit(none, ~L.held_out())
    assert {r.lang_pred for r in L.identify(odd, empty).collect()} == {"und"}


def test_all_of_many_languages_are_learned(spark, monkeypatch):
    monkeypatch.setattr(L, "SCORE_BYTES", 1 << 20)
    rng = random.Random(5)
    tongues = [["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 7))) for _ in range(12)] for _ in range(300)]
    rows = [(4 * k + n, " ".join(rng.choice(t) for _ in range(50)), f"l{k:03d}") for k, t in enumerate(tongues) for n in range(4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = L.fit(docs, F.col("doc_id") % 4 != 0)
    assert len(model.languages) == 300 and model.weights.nbytes <= L.MODEL_BYTES
    got = L.predict([t.encode() for i, t, _ in rows if i % 4 == 0], model)
    assert got["lang_pred"] == [f"l{k:03d}" for k in range(300)]
    assert [L.bucket_bits(n) for n in (1, 512, 513, 16_384)] == [15, 15, 14, 10]
    with pytest.raises(ValueError):
        L.bucket_bits(16_385)


def test_pieces_of_a_long_text_give_the_same_labels():
    rng = np.random.default_rng(1)
    for _ in range(100):
        k, n = int(rng.integers(1, 20)), int(rng.integers(1, 200))
        scores = (rng.normal(size=(n, k)) * rng.choice([0.3, 3.0])).astype(np.float32)
        trellis = L.Trellis(penalty=2.0)
        for at in range(0, n, 37):
            trellis.add(scores[at : at + 37])
        assert (trellis.path() == L.label(scores, np.zeros(n, np.int64), 1, penalty=2.0)).all()


def plain(text, model):
    """Language and share of one text: words, trigrams and paths one by one."""
    text = (text or "").lower()
    words, at = [], 0
    while at < len(text):
        end = at
        while end < len(text) and text[end].isalpha():
            end += 1
        if end > at:
            words.append((at, end))
        at = max(end, at + 1)
    if not words:
        return "und", 0.0
    code = lambda i: ord(text[i]) if 0 <= i < len(text) and text[i].isalpha() else 0
    k = range(len(model.languages))
    value, back = None, []
    for a, b in words:
        scores = [0.0] * len(k)
        for i in range(a, b):
            mix = (code(i - 1) * 0x9E3779B1 + code(i) * 0x85EBCA77 + code(i + 1) * 0xC2B2AE3D) % (1 << 32)
            mix = (mix ^ mix >> 15) * 0x2C1B3C6D % (1 << 32)
            scores = [s + float(model.weights[mix >> 17, x]) for x, s in zip(k, scores)]
        script = [name for start, name in L.SCRIPTS if start <= ord(text[a])][-1]
        allowed = model.allowed[L.SCRIPT_NAMES.index(script)]
        scores = [s if allowed[x] else min(scores) - 50 for x, s in zip(k, scores)]
        if value is None:
            value = scores
            continue
        top = max(k, key=lambda x: value[x])
        back.append([x if value[x] >= value[top] - L.SWITCH_PENALTY else top for x in k])
        value = [max(value[x], value[top] - L.SWITCH_PENALTY) + scores[x] for x in k]
    path = [max(k, key=lambda x: value[x])]
    for step in reversed(back):
        path.append(step[path[-1]])
    letters = [0] * len(k)
    for (a, b), x in zip(words, reversed(path)):
        letters[x] += b - a
    best = max(k, key=lambda x: letters[x])
    return model.languages[best], letters[best] / sum(letters)


def test_predictions_against_plain_version(spark, documents, odd):
    model = L.fit(documents, ~L.held_out())
    texts = [r.text for r in documents.orderBy("doc_id").collect() if len(r.text) < 4000][:250] + [r.text for r in odd.collect()]
    texts += [" ".join(x for pair in zip(a.split(), b.split()) for x in pair) for a, b in zip(texts[:20], texts[20:40])] + ["été über niño " * 9, "дом house"]
    got = L.predict([None if t is None else t.encode() for t in texts], model)
    want = [plain(t, model) for t in texts]
    assert got["lang_pred"] == [w[0] for w in want]
    assert np.allclose(got["score"], [w[1] for w in want])


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(0)
    for _ in range(200):
        sizes = rng.integers(1, 6, 4)
        k = int(rng.integers(2, 4))
        weights = rng.normal(size=(int(sizes.sum()), k)).astype(np.float32)
        path = L.label(weights, np.repeat(np.arange(4), sizes), 4, penalty=0.7)
        at = 0
        for size in sizes:
            value = lambda p: sum(weights[at + i, x] for i, x in enumerate(p)) - 0.7 * sum(x != y for x, y in zip(p, p[1:]))  # noqa: B023, E731
            best = max(value(p) for p in itertools.product(range(k), repeat=int(size)))
            assert abs(value(path[at : at + size]) - best) < 1e-4
            at += size


def test_spans_of_mixed_text_and_scripts(spark, documents):
    some = {r.lang: r.text for r in documents.where("length(text) between 400 and 900").collect()}
    rows = [(1, "en", "the and of "), (2, "ru", "привет как дела мир это текст "), (3, "el", "καλημέρα κόσμε αυτό είναι κείμενο ")]
    extra = spark.createDataFrame([(1000 + 10 * i + k, t * 20, g) for i, g, t in rows for k in range(9)], "doc_id bigint, text string, lang string")
    model = L.fit(documents.select("doc_id", "text", "lang").unionByName(extra), ~L.held_out())
    mixed = (some["en"] + " " + some["de"] + " привет мир").encode()
    got = L.predict([mixed, "это текст".encode(), b"", None], model, spans=True)
    assert [s["lang"] for s in got["spans"][0]] == ["en", "de", "ru"]
    assert got["spans"][0][-1]["end_word"] - got["spans"][0][-1]["first_word"] == 2
    assert got["lang_pred"][1:] == ["ru", "und", "und"]


def test_long_texts_are_taken_in_pieces(spark, documents, monkeypatch):
    model = L.fit(documents, ~L.held_out())
    texts = [r.text.encode() for r in documents.limit(60).collect()] + [b"", None, b"1 2 " * 4000]
    texts += [b" ".join(t for t in texts[:40]), b"a b " * 5000]
    whole = L.predict(texts, model, spans=True)
    monkeypatch.setattr(L, "SCORE_BYTES", 1)
    assert L.predict(texts, model, spans=True) == whole
    L.predict(["é".encode() * 9000], model)  # a word beyond a piece is cut
    for most in (7, 500, 1 << 20):
        back = [b""] * len(texts)
        for t, k in [x for g in L.pieces(texts, most) for x in g]:
            t.decode()
            back[k] += t
        assert back == [t or b"" for t in texts]
