import json

import pytest
from pyspark.sql import functions as F

from corpuskit.functions.patterns import rx
from corpuskit.operators import evalstore, sampling, vectors
from corpuskit.sources import benchmarks, evalruns, jsonl, sinks


@pytest.fixture()
def lines(tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"a": "x"}\n\n{broken\n{"a": "é"}\n', encoding="utf-8")
    return f"file://{p}"


def test_jsonl_modes(spark, lines, tmp_path):
    assert [(r.row_id, r.a) for r in jsonl.read_jsonl(spark, lines, "a string").orderBy("row_id").collect()] == [(0, "x"), (3, "é")]
    counted = jsonl.read_jsonl(spark, lines, "a string", mode="count")
    assert counted.where("parse_failed").count() == 1 and counted.count() == 3
    with pytest.raises(Exception, match="(?i)malformed"):
        jsonl.read_jsonl(spark, lines, "a string", mode="fail").collect()
    two = jsonl.read_jsonl(spark, [lines, "file:///no/such", lines], "a string")
    assert sorted(r.row_id for r in two.collect()) == [0, 3, 4, 7]
    assert jsonl.read_jsonl(spark, [lines, lines], "a string", max_rows=4).count() == 2
    assert jsonl.read_jsonl(spark, "file:///no/such", "a string", mode="count").count() == 0
    assert jsonl.count_rows(spark, lines) == 3


def test_row_ids_over_partitions(spark, tmp_path):
    df = spark.range(0, 1000, numPartitions=7).select(F.col("id").cast("string").alias("value"))
    assert all(int(r.value) == r.row_id for r in jsonl.with_row_ids(df).collect())


def test_splits_filters_and_texts(spark, lines, tmp_path):
    united = jsonl.read_splits(spark, {("c", "train"): lines, ("c", "test"): "file:///no/such"}, "a string")
    assert {(r.source_config, r.split) for r in united.collect()} == {("c", "train")}
    rows = spark.createDataFrame([(0, "abc", None), (1, None, "xyz"), (2, "q", "q")], "row_id long, a string, b string")
    assert [r.row_id for r in jsonl.matching(rows, rx("XY", "i")).collect()] == [1]
    assert jsonl.matching(rows, "nothing").count() == 0 and jsonl.matching(rows, "nothing", fallback=True).count() == 3
    assert jsonl.matching(rows, "xyz", max_rows=1).count() == 0
    p = tmp_path / "b.json"
    p.write_text(json.dumps({"t": "one", "l": ["two", ""], "d": {"x": "three", "y": ["four"], "n": 5}}))
    assert sorted(r.text for r in jsonl.read_texts(spark, [f"file://{p}", "file:///no/such"], "b").collect()) == ["four", "one", "three", "two"]
    assert jsonl.read_json(spark, "file:///no/such.json", "a int").count() == 0


def test_sinks(spark, tmp_path, lines):
    kept = jsonl.read_jsonl(spark, lines, "a string", keep_line=True)
    sinks.write_lines(kept, f"file://{tmp_path}/out")
    assert [r.value for r in spark.read.text(f"file://{tmp_path}/out").collect()] == ['{"a": "x"}', '{"a": "é"}']
    sinks.write_jsonl(kept.select("row_id", "a"), f"file://{tmp_path}/json", one_file=True)
    assert "é" in "".join(p.read_text("utf-8") for p in (tmp_path / "json").glob("part*"))
    rows = spark.createDataFrame([(k, "s" + str(k % 2)) for k in range(9)], "row_id long, g string")
    sinks.write_slices(sampling.per_stratum(rows, F.col("g"), 3), f"file://{tmp_path}/slices")
    index = spark.read.json(f"file://{tmp_path}/slices/index").collect()
    assert {(r.slice, r["count"]) for r in index} == {("s0", 3), ("s1", 3)}
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert sorted(map(tuple, sinks.upsert(old, new, "k").collect())) == [(1, "a"), (2, "c"), (3, "d")]
    edges = spark.createDataFrame([(1, 2, 0.99, 1), (1, 3, 0.94, 2)], "src long, dst long, score double, rank int")
    sinks.write_bands(vectors.bands(edges), f"file://{tmp_path}/bands")
    assert sorted(p.name for p in (tmp_path / "bands").glob("file=*")) == ["file=band_0.93-0.96", "file=band_from0.99"]


def test_resumed_embeddings(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a b"), (2, "c")], "row_id long, text string")
    path = f"file://{tmp_path}/emb"
    sinks.resume_embeddings(rows.where("row_id = 1"), vectors.feature_hash_provider(4), path)
    got = {r.row_id: list(r.embedding) for r in sinks.resume_embeddings(rows, vectors.feature_hash_provider(8), path).collect()}
    assert len(got[1]) == 4 and len(got[2]) == 8  # the first was not made again


def test_provider_batches_are_halved_and_retried():
    calls = []

    def provider(texts):
        calls.append(len(texts))
        if len(texts) > 2:
            raise ValueError("too many tokens")
        if len(calls) == 3:
            raise OSError("try again")
        return [[1.0]] * len(texts)

    assert len(vectors.send(provider, list("abcde"), wait=0)) == 5 and 2 in calls


def test_benchmarks(spark):
    a = spark.createDataFrame([(0, "What is the capital?", "Cairo", None, "Rome", "Oslo"), (1, "x", None, None, None, None)], "row_id long, Question string, `Option 1` string, `Option 2` string, `Option 3` string, `Option 4` string")
    b = spark.createDataFrame([(0, "Which of these?", ["p", "q"])], "row_id long, question string, choices array<string>")
    c = spark.createDataFrame([(5, "a text that is longer than twenty characters")], "row_id long, other string")
    got = benchmarks.questions({("arabic_mmlu", "d", "test"): a, ("arabic_mmmlu", "d", "test"): b, ("alrage", "d", "train"): c, ("alrage", "d", "test"): c, ("unknown", "d", "test"): a})
    assert sorted((r.benchmark, r["index"], r.text) for r in got.collect()) == [
        ("alrage", 5, "a text that is longer than twenty characters"), ("arabic_mmlu", 0, "What is the capital? A) Cairo C) Rome D) Oslo"), ("arabic_mmmlu", 0, "Which of these? A) p B) q"),
    ]


def test_evaluation_import(spark, tmp_path):
    stat = lambda name, **v: {"name": {"name": name}, **v}
    for sub, n in (("bio", 3), ("law", 2)):
        d = tmp_path / "suite" / f"bench:subset={sub},model=m"
        d.mkdir(parents=True)
        (d / "run_spec.json").write_text(json.dumps({"name": f"bench:subset={sub}", "adapter_spec": {"model": "org/m-thinking"}, "scenario_spec": {"class_name": "x.BenchScenario"}}))
        (d / "stats.json").write_text(json.dumps([stat("exact_match", mean=0.1), stat("exact_match", mean=0.5), stat("alrage_score", sum=2.0), stat("other", mean=1)]))
        (d / "per_instance_stats.json").write_text(json.dumps([{"instance_id": f"id{k}", "stats": [stat("exact_match", mean=float(k == 0)), stat("num_completion_tokens", sum=4.0)]} for k in range(n)]))
        states = [
            {"instance": {"id": f"id{k}", "input": {"text": "سؤال"}, "references": [{"output": {"text": "no"}, "tags": []}, {"output": {"text": "yes"}, "tags": ["correct"]}]}, "output_mapping": {"A": "yes"},
             "request": {"prompt": "p"}, "result": {"completions": [{"text": "A", "finish_reason": {"reason": "stop"}}], "request_time": 0.5}}
            for k in range(n)
        ]
        (d / "scenario_state.json").write_text(json.dumps({"request_states": states}, ensure_ascii=False))
    (tmp_path / "suite" / "incomplete").mkdir()
    dirs = evalruns.discover(spark, f"file://{tmp_path}/suite")
    assert len(dirs) == 2
    metrics = evalstore.instance_metrics(evalruns.instance_stats(spark, dirs))
    states = evalruns.states(spark, dirs)
    samples = evalstore.samples(states, metrics)
    assert sorted((r.category, r.sample_index, r.prediction, r.reference, r.judge_score, r.latency_ms, r.format, r.answer_tokens) for r in samples.collect()) == [
        (c, k, "yes", "yes", float(k == 0), 500.0, "MCQ_2", 4) for c, n in (("bio", 3), ("law", 2)) for k in range(n)
    ]
    totals = states.groupBy("run_dir").agg(F.count(F.lit(1)).alias("total_samples"))
    runs = evalstore.runs(evalruns.specs(spark, dirs), evalstore.run_metrics(evalruns.stats(spark, dirs)), totals, "s")
    got = runs.orderBy("run_dir").collect()
    assert [(r.task_name, r.total_samples, r.is_thinking_model, r.metrics) for r in got] == [("bench", n, True, {"exact_match": 0.5, "alrage_score": 2.0}) for n in (3, 2)]
    out = f"file://{tmp_path}/store"
    stored = evalruns.stored_runs(spark, f"{out}/runs")
    new = evalstore.with_ids(evalstore.new_runs(runs, stored), stored)
    assert sorted(r.id for r in new.collect()) == [1, 2]
    sinks.append_run(new, samples, f"{out}/runs", f"{out}/samples")
    assert evalstore.new_runs(runs, evalruns.stored_runs(spark, f"{out}/runs")).count() == 0
    copy = f"file://{tmp_path}/copy"
    for t in ("runs", "samples"):
        spark.read.parquet(f"{out}/{t}").write.parquet(f"{copy}/{t}")
    dirs_stored = sorted(r.run_dir for r in spark.read.parquet(f"{copy}/runs").collect())
    sinks.update_runs(spark, spark.createDataFrame([(dirs_stored[0], "failed")], "run_dir string, status string"), f"{copy}/runs")
    assert {r.run_dir: r.status for r in spark.read.parquet(f"{copy}/runs").collect()} == {d: "failed" if d == dirs_stored[0] else "completed" for d in dirs_stored}
    sinks.drop_runs(spark, spark.createDataFrame([(dirs_stored[0],)], "run_dir string"), f"{copy}/runs", f"{copy}/samples")
    assert [r.run_dir for r in spark.read.parquet(f"{copy}/runs").collect()] == dirs_stored[1:]
    assert {r.run_dir for r in spark.read.parquet(f"{copy}/samples").collect()} <= set(dirs_stored[1:])
    sinks.rewrite(spark, f"{copy}/runs", lambda rows: rows.limit(0))
    sinks.drop_orphans(spark, f"{copy}/runs", f"{copy}/samples")
    assert spark.read.parquet(f"{copy}/samples").count() == 0
    report = {r.task: r for r in evalstore.task_report(evalstore.subset_report(evalruns.instance_stats(spark, dirs), metrics, totals)).collect()}
    assert report["bench"].samples == 5 and abs(report["bench"].score - 0.4) < 1e-9
