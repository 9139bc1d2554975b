import math
import random
import sys

import pytest
from pyspark.sql import functions as F

from corpuskit import staging
from corpuskit.functions.numbers import round_exact
from corpuskit.operators import synth
from corpuskit.plans import evaluate
from corpuskit.sources import benchmarks


def test_rounding_is_that_of_the_exact_value(spark):
    rng = random.Random(1)
    values = [0.25, 0.35, 2.675, 0.5, 1.5, 2.5, -0.25, -2.675, 0.05, 0.15, 0.45, 1e-7, 0.00005, 0.00015, 123456.785, 1e12 + 0.25, 0.0, 4.0e13, 1e300]
    values += [rng.choice([-1, 1]) * rng.random() * 10 ** rng.randint(-6, 9) for _ in range(2000)] + [rng.randint(0, 10**6) / 2**k for k in range(1, 20) for _ in range(50)]
    values += [(2 * rng.randint(0, 10**5) + 1) / 2 / 10**d for d in range(5) for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in range(5):
        got = [r.y for r in df.select(round_exact("x", digits).alias("y")).collect()]
        assert got == [round(v, digits) for v in values]
    odd = spark.createDataFrame([(None,), (math.inf,), (math.nan,)], "x double").select(round_exact("x", 1).alias("y")).collect()
    assert odd[0].y is None and odd[1].y == math.inf and math.isnan(odd[2].y)


def test_request_bodies(spark):
    rows = [([("user", "hi")],), ([("system", "s"), ("user", "hi")],), ([],)]
    df = spark.createDataFrame(rows, "messages array<struct<role:string,content:string>>")
    got = [r.b for r in df.select(synth.request_body(F.col("messages"), "m", "be short").alias("b")).collect()]
    assert got[0] == '{"model":"m","messages":[{"role":"system","content":"be short"},{"role":"user","content":"hi"}],"reasoning_effort":"off"}'
    assert got[1].count("system") == 1 and got[2] == '{"model":"m","messages":[],"reasoning_effort":"off"}'
    plain = df.select(synth.request_body(F.col("messages"), "m").alias("b")).first().b
    assert "system" not in plain


def test_generation_asks_again_within_its_budget(spark):
    topics = spark.createDataFrame([(f"t{k}", "easy", ["a"]) for k in range(3)], "topic string, difficulty string, focus array<string>")
    good = '{"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}'
    templates = {"mcq": "Q {topic} {difficulty} {focus}", "dialogue": "D {topic} {difficulty} {focus}"}
    answer = lambda prompt: good if prompt.startswith("D") else "no json"
    got = synth.generate(topics, 10, templates, "s", answer, budget=2).collect()
    assert sorted(r.task for r in got) == [8, 9] and all(r.type == "dialogue" for r in got)


def test_loaders(spark):
    loaders = benchmarks.Loaders()
    loaders.register("plain", lambda spark, config, split: ["a text of some length here", "another text of some length"])
    loaders.register("aratrust", lambda spark, config, split: spark.createDataFrame([("What is it?", "x", "", "z")], "Question string, A string, B string, C string"))
    wanted = [("plain", "c", "test"), ("aratrust", "c", "test"), ("unknown", "c", "test")]
    assert set(loaders.load(spark, wanted)) == set(wanted[:2])
    got = sorted(tuple(r) for r in loaders.texts(spark, wanted).collect())
    assert got == [("aratrust", "What is it?\nA) x\nC) z"), ("plain", "a text of some length here"), ("plain", "another text of some length")]
    assert loaders.texts(spark, []).count() == 0


def test_evaluator(spark, tmp_path):
    specs = spark.createDataFrame([("b", 1, "b:model=m"), ("a", 0, "a:x=y,model=m")], "benchmark string, place int, spec string")
    program = "import sys; sys.exit(open(sys.argv[1]).read() != 'a:x=y,model=m\\nb:model=m\\n')"
    path = str(tmp_path / "specs.txt")
    assert evaluate.evaluate(specs, path, lambda p: [sys.executable, "-c", program, p]) == 2
    with pytest.raises(RuntimeError):
        evaluate.evaluate(specs, path, lambda p: ["x"], runner=lambda command: 3)


def test_a_cluster_needs_a_shared_folder():
    class Fake:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            applicationId, master = "app-x", "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_path(Fake, "x")
