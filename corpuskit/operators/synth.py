"""Synthesis of training examples: schedule, templates, parsing, validation. The model is a provider that callers pass in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuskit.functions import chat
from corpuskit.functions import text as T
from corpuskit.functions.patterns import OPTION_LETTERS
from corpuskit.staging import staged

MCQ = "question string, options map<string,string>, answer string"
DIALOGUE = f"messages {chat.MESSAGES}"
MCQ_SHARE = 0.85


def schedule(topics: DataFrame, n: int, seed: int = 42, mcq_share: float = MCQ_SHARE) -> DataFrame:
    """``n`` tasks over ``topics`` (topic, difficulty, focus): every cycle takes each topic once, in an order of its own."""
    count = topics.count()
    cycles = -(-n // max(1, count))
    each = topics.withColumn("cycle", F.explode(F.sequence(F.lit(0), F.lit(max(0, cycles - 1)))))
    shuffled = F.md5(F.concat(F.lit(f"{seed}:"), F.col("cycle").cast("string"), F.lit(":"), F.col("topic")))
    place = F.row_number().over(Window.partitionBy("cycle").orderBy(shuffled, "topic"))
    task = each.withColumn("task", F.col("cycle") * count + place - 1).where(F.col("task") < n).drop("cycle")
    return task.withColumn("type", F.when(F.col("task") < int(n * mcq_share), "mcq").otherwise("dialogue"))


def prompts(tasks: DataFrame, templates: dict[str, str], system: str) -> DataFrame:
    """Adds raw_prompt and the messages that ask for it."""
    template = F.create_map(*[F.lit(x) for kv in templates.items() for x in kv])[F.col("type")]
    asked = tasks.withColumn("raw_prompt", T.fill_template(template, "topic", "difficulty", "focus"))
    message = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    return asked.withColumn("request", F.array(message("system", F.lit(system)), message("user", F.col("raw_prompt"))))


def ask(requests: DataFrame, provider, attempts: int = 4) -> DataFrame:
    """Adds raw_response by a provider (prompt -> text); after ``attempts`` failures it is null."""
    def one(prompt):
        import time

        for k in range(attempts):
            try:
                return provider(prompt)
            except Exception:
                time.sleep(0.01 * 2**k)
        return None

    def each(s):
        return s.map(one)

    return requests.withColumn("raw_response", F.pandas_udf(each, "string")("raw_prompt"))


def valid_mcq(question: Column, options: Column, answer: Column) -> Column:
    filled = F.forall(F.array(*[F.lit(x) for x in OPTION_LETTERS]), lambda k: F.trim(T.filled(F.try_element_at(options, k))) != "")
    return F.coalesce((T.filled(question) != "") & filled & F.map_contains_key(options, answer), F.lit(False))


def valid_dialogue(messages: Column) -> Column:
    good = F.forall(messages, lambda m: F.coalesce(m["role"].isin("user", "assistant"), F.lit(False)) & (T.filled(m["content"]) != ""))
    return F.coalesce((F.size(messages) >= 2) & good, F.lit(False))


def records(answered: DataFrame) -> DataFrame:
    """Valid answers as flat records; invalid ones are dropped."""
    body = T.json_object("raw_response")
    parsed = answered.withColumn("m", F.from_json(body, MCQ)).withColumn("d", F.from_json(body, DIALOGUE))
    m, d = F.col("m"), F.col("d")
    is_mcq = F.col("type") == "mcq"
    good = F.when(is_mcq, valid_mcq(m["question"], m["options"], m["answer"])).otherwise(valid_dialogue(d["messages"]))
    messages = F.when(is_mcq, chat.pair(chat.question_with_options(m["question"], m["options"]), m["answer"])).otherwise(d["messages"])
    return parsed.where(good).select(
        "task", F.lit("synthetic").alias("source"), "type", "topic", "difficulty", F.when(is_mcq, m["question"]).alias("question"), F.when(is_mcq, m["options"]).alias("options"),
        F.when(is_mcq, m["answer"]).alias("answer"), messages.alias("messages"), "raw_prompt", "raw_response",
    )


def request_body(messages: Column, model: str, system: str | None = None, effort: str = "off") -> Column:
    """The JSON body of a chat request: a system message in front unless there is one or none is wanted, and the reasoning effort."""
    has_system = F.exists(messages, lambda m: F.coalesce(m["role"] == "system", F.lit(False)))
    first = F.array(F.struct(F.lit("system").alias("role"), F.lit(system or "").alias("content")))
    asked = F.when((F.size(messages) > 0) & ~has_system, F.concat(first, messages)).otherwise(messages) if system else messages
    return F.to_json(F.struct(F.lit(model).alias("model"), asked.alias("messages"), F.lit(effort).alias("reasoning_effort")))


def generate(topics: DataFrame, n: int, templates: dict[str, str], system: str, provider, budget: int = 3, seed: int = 42) -> DataFrame:
    """Up to ``n`` valid records. Tasks whose answers are invalid are asked again, ``budget`` times in all; every round is written."""
    tasks, found = staged(prompts(schedule(topics, n, seed), templates, system), "tasks"), None
    for _ in range(budget):
        got = staged(records(ask(tasks, provider)), "records")
        found = got if found is None else found.unionByName(got)
        tasks = staged(tasks.join(got.select("task"), "task", "left_anti"), "tasks")
        if tasks.isEmpty():
            break
    return found
