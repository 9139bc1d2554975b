import json

import pytest
from pyspark.sql import functions as F

from corpuskit.functions.chat import MESSAGES
from corpuskit.operators import vectors
from corpuskit.plans import workflow
from corpuskit.streaming import profile as stream
from corpuskit import schema


def chats(spark):
    pair = lambda u, a: [("user", u), ("assistant", a)]
    rows = [(k, pair(f"what is the number {k} of the long list", f"answer {k}")) for k in range(20)]
    rows += [(20, pair("what is the number 3 of the  long list", "<think>t</think>answer 3")), (21, pair("what is the number 4 of the long list", "another")), (22, pair("about the benchmark", "no")), (23, pair("q", "the rubric"))]
    return spark.createDataFrame(rows, f"row_id long, messages {MESSAGES}")


def test_chat_corpus(spark, tmp_path):
    out = f"file://{tmp_path}/run"
    asked = spark.createDataFrame([(0, "exams", "what is the number 7 of the long list")], "row_id long, benchmark string, text string")
    flow = workflow.ChatCorpus(chats(spark), out, asked, workflow.Settings(threshold=0.999, leakage_threshold=0.999, provider=vectors.feature_hash_provider(1 << 14)))
    assert set(flow.run()) == set(workflow.STEPS)
    log = {r.row_id: r.reasons for r in flow.table("removal_log").collect()}
    assert log == {
        20: ["exact_duplicate"], 4: ["semantic_duplicate"], 22: ["leakage_high_confidence"], 23: ["leakage_high_confidence"], 7: ["embedding_leakage"],
    } or log == {20: ["exact_duplicate"], 21: ["semantic_duplicate"], 22: ["leakage_high_confidence"], 23: ["leakage_high_confidence"], 7: ["embedding_leakage"]}
    assert spark.read.json(f"{out}/clean").count() == 24 - len(log)
    assert "19 out" in (tmp_path / "run/report.md").read_text()
    report = json.loads((tmp_path / "run/profile.json").read_text())
    assert {x["metric"]: x["value"] for x in report["counters"]}["rows"] == 24
    assert flow.run("build", "build") and flow.table("removal_log").count() == len(log)
    with pytest.raises(ValueError):
        flow.run("build", "profile")


def test_all_leaks_are_removed(spark, tmp_path):
    rows = [(k, [("user", f"about the benchmark {k}"), ("assistant", "no")]) for k in range(130)]
    rows += [(k, [("user", f"q {k}"), ("assistant", "the rubric")]) for k in range(130, 250)] + [(250, [("user", "q"), ("assistant", "a")])]
    flow = workflow.ChatCorpus(spark.createDataFrame(rows, f"row_id long, messages {MESSAGES}"), f"file://{tmp_path}/run")
    flow.exact()
    flow.leakage()
    assert {r.row_id for r in flow.table("leak_high").collect()} == set(range(250))


def test_tuning_data(spark, tmp_path):
    arabic = "هذا سؤال طويل عن النحو والصرف في اللغة العربية وعن الإعراب والبناء رقم "
    records = [{"source": ("broad", "a", "b")[k % 3], "row": {"prompt": arabic + "اب تث جح خد ذر".split()[k % 5] * (k + 1), "response": "جواب " + str(k)}} for k in range(12)]
    records += [records[0], {"source": "a", "row": {"prompt": "english only", "response": "x"}}, {"row": {"question": "ما؟\nأ) نعم\nب) لا", "answer": "الجواب: ب"}}, {"row": {"prompt": "x"}}]
    lines = [(k, json.dumps(r, ensure_ascii=False)) for k, r in enumerate(records)]
    raw = spark.createDataFrame(lines, "row_id long, j string").select("row_id", F.from_json("j", schema.ENVELOPE).alias("e")).select("row_id", "e.*")
    none = spark.createDataFrame([], "benchmark string, text string")
    counts = workflow.tuning_data(raw, none, f"file://{tmp_path}", "sys", "broad", ["a", "b"], threshold=1.1)
    assert (counts["normalized"], counts["exact_deduped"], counts["deduped"], counts["phase1"], counts["phase2"]) == (14, 13, 13, 4, 8)
    asked = [r for r in spark.read.parquet(f"file://{tmp_path}/formatted").collect() if r.is_mcq]
    assert [m.role for m in asked[0].messages] == ["system", "user", "assistant"] and asked[0].messages[2].content == "ب"
    assert "phase2:\n  rows: 8" in (tmp_path / "curriculum.yaml").read_text()
    assert workflow.normalized(raw, compat=True).where("is_mcq").count() == 0


def test_tuning_data_embeds_whole_prompts(spark, tmp_path):
    letters = "ابتثجحخدذرزسشصضطظعغفقكلمنهوي"
    word = lambda k: "".join(letters[k // 28**p % 28] for p in range(4))
    shared = " ".join(word(k) for k in range(1_200))
    prompts = [shared + " " + " ".join(word(k) for k in range(b, b + 1_200)) for b in (100_000, 200_000)]
    assert len(shared) > 5_000
    lines = [(k, json.dumps({"source": "a", "row": {"prompt": p, "response": f"جواب {k}"}}, ensure_ascii=False)) for k, p in enumerate(prompts)]
    raw = spark.createDataFrame(lines, "row_id long, j string").select("row_id", F.from_json("j", schema.ENVELOPE).alias("e")).select("row_id", "e.*")
    none = spark.createDataFrame([], "benchmark string, text string")
    counts = workflow.tuning_data(raw, none, f"file://{tmp_path}", "sys", "broad", ["a"], provider=vectors.feature_hash_provider(1 << 12))
    assert (counts["exact_deduped"], counts["deduped"]) == (2, 2)


def test_streams(spark, tmp_path):
    events = spark.sql("SELECT timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, CAST(id AS INT)) AS ts, 'text ' || id % 5 AS text FROM range(20)")
    events.write.parquet(f"file://{tmp_path}/in")
    source = lambda: spark.readStream.schema(events.schema).parquet(f"file://{tmp_path}/in")

    def drained(df, name, mode):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", f"file://{tmp_path}/{name}").start()
        q.processAllAvailable()
        q.stop()
        return spark.table(name).collect()

    got = drained(stream.running_profile(source(), "text"), "running", "complete")
    assert sum(r.rows for r in got) == 20 and {r.language for r in got} == {"english"}
    assert len(drained(stream.first_copies(source().withColumn("a", F.lit("")), "text", "a"), "first", "append")) == 5
