"""Evaluation runs: JSON results to relational run and sample tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.functions import text as T
from corpuskit.sources.jsonl import with_row_ids
from corpuskit.staging import staged

INSTANCE_METRICS = ("exact_match", "num_completion_tokens", "inference_runtime", "alrage_score")
#: Fixed values of stored runs: the evaluator's name for a run in its configuration, and the judges.
RUN_NAME_KEY = "helm_run_name"
EXACT_JUDGE, MODEL_JUDGE = "helm_exact_match", "openai/gpt-4o-2024-11-20"
RUN_METRICS = ("exact_match", "quasi_exact_match", "prefix_exact_match", "alrage_score")

STAT = "struct<name:struct<name:string>,mean:double,sum:double>"
RUN_SPEC = "name string, adapter_spec struct<model:string,reasoning_effort:string>, scenario_spec struct<class_name:string>"
INSTANCE_STATS = f"instance_id string, stats array<{STAT}>"
REFERENCE = "struct<output:struct<text:string>,tags:array<string>>"
STATE = (
    f"struct<instance:struct<id:string,input:struct<text:string>,references:array<{REFERENCE}>>,output_mapping:map<string,string>,"
    "request:struct<prompt:string>,result:struct<completions:array<struct<text:string,finish_reason:struct<reason:string>>>,request_time:double>,annotations:string>"
)
SCENARIO_STATE = f"request_states array<{STATE}>"


def instance_metrics(stats: DataFrame, keys: tuple[str, ...] = ("run_dir", "instance_id")) -> DataFrame:
    """One row per instance with the four tracked metrics: mean, else sum, else 0; the last entry of a name counts.

    ``stats``: the keys, ``entry`` (the place of the instance's entry) and ``stats`` (an array).
    """
    each = stats.select(*keys, "entry", F.posexplode("stats").alias("pos", "s"))
    each = each.select(*keys, F.col("s.name.name").alias("name"), F.coalesce("s.mean", "s.sum", F.lit(0.0)).alias("value"), F.struct("entry", "pos").alias("at"))
    last = [F.max_by(F.when(F.col("name") == m, F.col("value")), F.when(F.col("name") == m, F.col("at"))).alias(m) for m in INSTANCE_METRICS]
    return each.where(F.col("name").isin(*INSTANCE_METRICS)).groupBy(*keys).agg(*last)


def correct_reference(references: Column) -> Column:
    return F.try_element_at(F.filter(references, lambda r: F.coalesce(F.array_contains(r["tags"], "correct"), F.lit(False))), F.lit(1))["output"]["text"]


def samples(states: DataFrame, metrics: DataFrame) -> DataFrame:
    """``states``: run_dir, idx, state (one request). Joined to its instance's metrics by (run_dir, instance_id)."""
    s, instance = F.col("state"), F.col("state.instance")
    instance_id = F.coalesce(instance["id"], F.concat(F.lit("id"), F.col("idx").cast("string")))
    completion = F.try_element_at(s["result"]["completions"], F.lit(1))
    raw = F.coalesce(completion["text"], F.lit(""))
    mapping = F.coalesce(s["output_mapping"], F.create_map().cast("map<string,string>"))
    references = F.coalesce(instance["references"], F.array().cast(f"array<{REFERENCE}>"))
    seconds = s["result"]["request_time"]
    meta = F.struct(
        mapping.alias("output_mapping"),
        F.transform(references, lambda r: F.struct(r["output"]["text"].alias("text"), F.coalesce(F.array_contains(r["tags"], "correct"), F.lit(False)).alias("correct"))).alias("all_references"),
        completion["finish_reason"]["reason"].alias("finish_reason"), instance_id.alias("instance_id"), F.nullif(s["annotations"], F.lit("")).alias("annotations"),
    )
    rows = states.select(
        "run_dir", instance_id.alias("instance_id"), T.instance_index(instance_id, F.col("idx")).alias("sample_index"), T.category_of("run_dir").alias("category"),
        T.answer_format(mapping, F.size(references)).alias("format"), F.coalesce(instance["input"]["text"], F.lit("")).alias("instruction"), correct_reference(references).alias("reference"),
        F.coalesce(F.try_element_at(mapping, raw), raw).alias("prediction"), F.coalesce(s["request"]["prompt"], F.lit("")).alias("raw_prompt"), raw.alias("raw_response"),
        F.when(seconds != 0, F.round(seconds * 1000, 2)).alias("latency_ms"), F.to_json(meta).alias("meta"),
    )
    scored = rows.join(metrics, ["run_dir", "instance_id"], "left")
    return scored.select(
        "run_dir", "sample_index", "category", "format", "instruction", "reference", "prediction", "raw_prompt", "raw_response",
        F.coalesce("exact_match", "alrage_score").alias("judge_score"), "latency_ms", F.col("num_completion_tokens").cast("int").alias("answer_tokens"), "meta",
    )


def run_metrics(stats: DataFrame) -> DataFrame:
    """(run_dir, metrics: map): mean, else sum, of the four run metrics; the last entry of a name counts."""
    each = stats.select("run_dir", F.posexplode("stats").alias("pos", "s")).select("run_dir", "pos", F.col("s.name.name").alias("name"), F.coalesce("s.mean", "s.sum").alias("value"))
    last = each.where(F.col("name").isin(*RUN_METRICS)).groupBy("run_dir", "name").agg(F.max_by("value", "pos").alias("value"))
    return last.groupBy("run_dir").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("name", "value")))).alias("metrics"))


def runs(specs: DataFrame, metrics: DataFrame, totals: DataFrame, suite: str, commit: str = "", branch: str = "") -> DataFrame:
    """One row per run directory. ``specs``: run_dir and RUN_SPEC; ``totals``: run_dir, total_samples."""
    model = F.coalesce(F.col("adapter_spec.model"), F.lit("unknown"))
    scenario = F.coalesce(F.col("scenario_spec.class_name"), F.lit(""))
    config = F.to_json(F.struct(F.lit(suite).alias("suite"), F.lit(commit).alias("git_commit"), F.lit(branch).alias("git_branch"), "adapter_spec", "scenario_spec", F.coalesce("name", F.lit("")).alias(RUN_NAME_KEY)))
    judge = F.when(F.lower(scenario).contains("alrage"), MODEL_JUDGE).otherwise(EXACT_JUDGE)
    rows = specs.select(
        "run_dir", F.coalesce("name", F.lit("")).alias("run_name"), model.alias("model_name"), T.task_of(scenario, F.coalesce("name", F.lit("unknown"))).alias("task_name"),
        judge.alias("judge_model"), F.lit("completed").alias("status"), config.alias("config"), T.is_thinking_model(model, F.col("adapter_spec.reasoning_effort")).alias("is_thinking_model"),
    )
    return rows.join(metrics, "run_dir", "left").join(totals, "run_dir", "left").na.fill(0, ["total_samples"])


def new_runs(found: DataFrame, stored: DataFrame) -> DataFrame:
    """Runs whose name is not stored yet; of equal names in one import the first directory counts."""
    first = Window.partitionBy("run_name").orderBy("run_dir")
    return found.join(stored.select("run_name").distinct(), "run_name", "left_anti").withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")


def with_ids(new: DataFrame, stored: DataFrame) -> DataFrame:
    """Surrogate ids behind the highest stored one, in the order of directories; rows are numbered where they lie."""
    start = stored.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    return with_row_ids(staged(new.orderBy("run_dir"), "new-runs"), "id").withColumn("id", F.col("id") + F.lit(start + 1))


def subset_report(stats: DataFrame, metrics: DataFrame, totals: DataFrame) -> DataFrame:
    """(task, subset, samples, score): run directories grouped by the part before the colon.

    Generation tasks score the mean over instances; the others the share of instances with an exact match of 1 over stored samples.
    """
    part = lambda df: df.withColumn("task", F.split("run_dir", ":")[0]).withColumn("subset", F.coalesce(T.category_of("run_dir"), F.col("run_dir")))
    each = part(metrics).groupBy("task", "subset", "run_dir").agg(F.count("alrage_score").alias("judged"), F.sum("alrage_score").alias("score_sum"), F.count_if(F.col("exact_match") == 1.0).alias("correct"))
    joined = each.join(totals, "run_dir", "left")
    value = F.when(F.col("judged") > 0, F.col("score_sum") / F.col("total_samples")).otherwise(F.col("correct") / F.col("total_samples"))
    return joined.select("task", "subset", F.coalesce("total_samples", F.lit(0)).alias("samples"), value.alias("score"))


def task_report(subsets: DataFrame) -> DataFrame:
    """(task, samples, score, per_subset) over the subsets of a task."""
    return subsets.groupBy("task").agg(
        F.sum("samples").alias("samples"), (F.sum(F.col("score") * F.col("samples")) / F.sum("samples")).alias("score"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("subset", "score")))).alias("per_subset"),
    )
