"""Micro-fixtures of canonical forms, classifiers, digests, histograms and shapes."""

import hashlib

import pytest
from pyspark.sql import functions as F

from corpuskit import schema
from corpuskit.functions import chat
from corpuskit.functions import text as T
from corpuskit.operators import profile, synth


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f("x").alias("y")).first().y


@pytest.mark.parametrize(
    "text, want",
    [
        ("كِتَابٌ", "كتاب"), ("أحمد إلى المدرسةِ، Biology؟", "احمد الي المدرسه, biology?"),
        ("مدرسة‏  على البيت", "مدرسه علي البيت"), ("", ""), (" \x1c  ", ""),
    ],
)
def test_canonical(spark, text, want):
    assert one(spark, text, T.canonical) == want


def test_canonical_ngrams(spark):
    assert one(spark, "أحمد إلى المدرسةِ، Biology؟", T.canonical_ngrams) == "احمد الي المدرسه biology"


@pytest.mark.parametrize(
    "text, want",
    [("اشرح نظرية Einstein في الفيزياء", "mixed"), ("ما هي عاصمة مصر؟", "arabic"), ("hello world", "english"), ("123", "other"), ("مرحبا hello", "mixed"), ("éà", "other")],
)
def test_language(spark, text, want):
    assert one(spark, text, T.language) == want


def test_question_types(spark):
    raw = "ما عاصمة مصر؟\nأ) القاهرة\nب) دمشق"
    assert one(spark, raw, T.is_mcq_line) and not one(spark, raw, lambda x: T.is_mcq_line(T.unicode_clean(x)))
    assert one(spark, "Pick: A) x B) y", T.is_mcq) and not one(spark, "Pick A) only", T.is_mcq) and one(spark, "Choose A) one", T.is_mcq)
    assert one(spark, "x\n1) a\n2) b", T.is_mcq_broad) and not one(spark, "x\n1) a\n2) b", T.is_mcq)
    assert one(spark, "اختر الإجابة", T.is_mcq_broad) and not one(spark, "plain", T.is_mcq_broad)


def test_unicode_clean(spark):
    assert one(spark, "a\r\nb\rc d​e f ﷺ ①", T.unicode_clean) == "a bcde f صلى الله عليه وسلم 1"
    assert one(spark, None, T.unicode_clean) is None


@pytest.mark.parametrize("text, compat, strict", [("د", "د", "د"), ("الإجابة: د", "ج", "د"), ("Answer: C", "ج", "ج"), ("E", "هـ", "هـ"), ("هـ", "ه", "هـ"), ("none", "none", "none"), ("", "", "")])
def test_answer_letter(spark, text, compat, strict):
    assert one(spark, text, T.answer_letter) == compat
    assert one(spark, text, lambda x: T.answer_letter(x, compat=False)) == strict


def test_think(spark):
    text = "x<think>a\nb</think>y<think>c</think>z<think>open"
    assert one(spark, text, T.strip_think) == "xyz<think>open"
    assert one(spark, text, T.think_lengths) == [3, 1]


def test_digests(spark):
    got = spark.createDataFrame([("u", "a")], "u string, a string").select(T.pair_digest("u", "a").alias("d"), T.gram_digest("u").alias("g")).first()
    assert got.d == hashlib.sha256(b"u\0a").hexdigest() and got.g == hashlib.sha1(b"u").hexdigest()


def test_flags(spark):
    assert one(spark, "see benchmark", lambda x: T.mentions(x, F.lit(""))) and not one(spark, "benchmarks", lambda x: T.mentions(x, F.lit("")))
    assert one(spark, "نص", lambda x: T.mentions(F.lit("arabic-mmlu"), x))
    assert one(spark, "The rubric", T.leaks_rubric) and not one(spark, "no", T.leaks_rubric)
    assert one(spark, "explain in detail Biology", lambda x: T.fingerprints(x, F.lit(""))) == ["arabic_mmlu", "alrage"]
    assert one(spark, "x", lambda x: T.fingerprints(x, F.lit("أرفض تقديم محتوى ضار"))) == ["aratrust"]
    assert one(spark, "العبارة صحيح\nتم", lambda x: T.fingerprints(x, F.lit(""))) == ["alghafa"]
    assert one(spark, "review of biology", T.topics) == ["mmlu_subject", "alghafa_sentiment"]
    assert one(spark, "آ ة ى ٌ", lambda x: F.array(*T.orthography(x).values())) == [True] * 4
    assert one(spark, "The answer is: 4", T.wrappers) == ["The answer is:"]
    assert one(spark, "```x```", T.has_code) and one(spark, "at https://x", T.has_url)


def test_ngrams(spark):
    grams = lambda n: one(spark, "a b c", lambda x: T.ngrams(T.tokens(x), n))
    assert grams(2) == ["a b", "b c"] and grams(3) == ["a b c"] and grams(4) == []


def test_options_and_templates(spark):
    assert one(spark, ["x", "", None, "w"], lambda o: T.options_text(F.lit("q"), o), "array<string>") == "q\nA) x\nD) w"
    got = one(spark, ["f", "g"], lambda x: T.fill_template(F.lit("{topic}/{difficulty}/{focus}"), F.lit("t"), F.lit("d"), x), "array<string>")
    assert got == "t/d/f، g"


def test_json_object(spark):
    assert one(spark, "```json\n{\"a\": {\"b\": 1}}\n```", T.json_object) == '{"a": {"b": 1}}'
    assert one(spark, "nothing", T.json_object) is None


def test_run_names(spark):
    assert one(spark, "bench:subset=bio,model=m", T.category_of) == "bio" and one(spark, "bench:model=m", T.category_of) is None
    assert one(spark, "a.b.AlGhafaScenario", lambda x: T.task_of(x, F.lit("r:1"))) == "alghafa" and one(spark, "", lambda x: T.task_of(x, F.lit("r:1"))) == "r"
    assert one(spark, "id42", lambda x: T.instance_index(x, F.lit(7))) == 42 and one(spark, "odd", lambda x: T.instance_index(x, F.lit(7))) == 7
    assert one(spark, "m-Thinking", lambda x: T.is_thinking_model(x, F.lit("off"))) and not one(spark, "m", lambda x: T.is_thinking_model(x, F.lit(None).cast("string")))
    assert one(spark, "m", lambda x: T.is_thinking_model(x, F.lit("high")))


def test_histogram_edges(spark):
    df = spark.createDataFrame([(x,) for x in (-1.0, 0.5, 1.01, 1.02, 0.99)], "v double")
    assert [r["count"] for r in profile.edge_histogram(df, F.col("v"), (0, 0.5, 0.99, 1.01)).orderBy("bin").collect()] == [0, 1, 2]


def test_percentiles_and_moments(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (10.0,)], "v double")
    assert round(profile.percentiles(df, F.col("v")).first().p90, 6) == 8.4
    import numpy as np

    values = [float(x) for x in np.random.default_rng(0).choice([0.0, 1.5, *np.random.default_rng(1).normal(size=300)], 900)]
    many = spark.createDataFrame([(x,) for x in values], "v double")
    got = profile.percentiles(many, F.col("v"), ranges=5, most=20).first()
    assert np.allclose([got.p50, got.p90, got.p95, got.p99], np.percentile(values, [50, 90, 95, 99]))
    assert profile.percentiles(many.limit(0), F.col("v")).first().p50 is None
    m = profile.moments(df, {"v": F.col("v")}).first()
    assert (m["count"], round(m.std, 4), m.min, m.max, m.total) == (3, 4.0277, 1.0, 10.0, 13.0)


def test_messages(spark):
    rows = [(1, [("system", "s"), ("user", "u1"), ("assistant", "a1"), ("user", "u2"), ("assistant", "<think>xxxxxxxx</think> a2 ")]), (2, []), (3, [("user", None)])]
    df = spark.createDataFrame(rows, f"id int, m {chat.MESSAGES}")
    m = F.col("m")
    got = df.select(
        chat.last(m, "user"), chat.first(m, "user"), chat.last(m, "assistant"), chat.longest_assistant(m), chat.role_path(m),
        F.size(chat.with_system(m, F.lit("p"))), F.size(chat.with_system(m, F.lit("p"), anywhere=True)),
    ).collect()
    assert tuple(got[0]) == ("u2", "u1", "<think>xxxxxxxx</think> a2 ", 2, "system->user->assistant->user->assistant", 5, 5)
    assert tuple(got[1]) == ("", "", "", 0, "", 1, 1) and tuple(got[2]) == ("", "", "", 0, "user", 2, 2)


def test_shapes(spark):
    import json

    rows = [
        {"messages": [{"role": "user", "content": "m"}], "prompt": "p", "response": "r"},
        {"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}, {"from": "gpt", "value": ""}, {"role": "system", "content": "s"}]},
        {"instruction": "i", "input": "n", "output": "o"}, {"instruction": "i", "output": ""}, {"prompt": "p", "response": "r"},
        {"question": "q", "answer": "أ", "options": {"أ": "1", "ج": "3"}}, {"question": "q", "answer": "a"}, {"user": "u", "assistant": "a"}, {"prompt": "p"},
    ]
    df = spark.createDataFrame([(k, json.dumps(r, ensure_ascii=False)) for k, r in enumerate(rows)], "k int, j string")
    got = df.select("k", chat.dispatch(F.from_json("j", chat.ROW)).alias("m")).orderBy("k").collect()
    pairs = [[(x.role, x.content) for x in r.m] if r.m is not None else None for r in got]
    ua = lambda u, a: [("user", u), ("assistant", a)]
    assert pairs == [
        [("user", "m")], [("user", "h"), ("assistant", "g"), ("system", "s")], ua("i\nn", "o"), ua("i", ""), ua("p", "r"),
        ua("q\nأ) 1\nب) \nج) 3\nد) ", "أ"), ua("q", "a"), ua("u", "a"), None,
    ]


def test_synthesis(spark):
    import json

    topics = spark.createDataFrame([(t, "easy", ["f"]) for t in ("x", "y", "z")], "topic string, difficulty string, focus array<string>")
    tasks = synth.schedule(topics, 20)
    rows = tasks.orderBy("task").collect()
    assert [r.task for r in rows] == list(range(20)) and sum(r.type == "mcq" for r in rows) == 17
    assert all(sorted(r.topic for r in rows[k : k + 3]) == ["x", "y", "z"] for k in range(0, 18, 3))
    good = {"question": "q", "options": {"أ": "1", "ب": "2", "ج": "3", "د": "4"}, "answer": "ب"}
    talk = {"messages": [{"role": "user", "content": "u"}, {"role": "assistant", "content": "a"}]}

    def provider(prompt):
        return "```json\n" + json.dumps(good if "MCQ" in prompt and "x" in prompt else talk if "TALK" in prompt else {**good, "answer": "z"}, ensure_ascii=False) + "\n```"

    asked = synth.ask(synth.prompts(tasks, {"mcq": "MCQ {topic}", "dialogue": "TALK {topic}"}, "sys"), provider)
    got = synth.records(asked).collect()
    assert {r.type for r in got} == {"mcq", "dialogue"} and all(r.topic == "x" for r in got if r.type == "mcq")
    assert all(r.messages[0].content.startswith("q\nأ) 1") for r in got if r.type == "mcq")


def test_catalogue_of_tables(spark):
    assert len(schema.TABLES) == 20
    for columns in [*schema.TABLES.values(), schema.CHAT, schema.ENVELOPE, schema.BENCHMARK, schema.GENERATED]:
        spark.createDataFrame([], columns)
