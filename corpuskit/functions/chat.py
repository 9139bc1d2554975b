"""Chat rows: extraction rules, role aliases and record shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.functions import text as T
from corpuskit.functions.patterns import OPTION_LETTERS

MESSAGES = "array<struct<role:string,content:string>>"
#: Columns of the record shapes that :func:`dispatch` knows; all are optional in a source.
ROW = (
    f"struct<messages:{MESSAGES},conversations:array<struct<role:string,`from`:string,content:string,value:string>>,instruction:string,input:string,"
    "output:string,prompt:string,response:string,question:string,options:map<string,string>,answer:string,user:string,assistant:string>"
)


def _of(messages: Column, role: str) -> Column:
    return F.filter(messages, lambda m: m["role"] == role)


def last(messages: Column, role: str) -> Column:
    """Content of the last message of a role; empty if there is none."""
    return F.coalesce(F.try_element_at(_of(messages, role), F.lit(-1))["content"], F.lit(""))


def first(messages: Column, role: str) -> Column:
    return F.coalesce(F.try_element_at(_of(messages, role), F.lit(1))["content"], F.lit(""))


def longest_assistant(messages: Column) -> Column:
    """Length of the longest assistant message without reasoning and outer white space; 0 if there is none."""
    sizes = F.transform(_of(messages, "assistant"), lambda m: F.length(F.trim(F.regexp_replace(T.strip_think(T.filled(m["content"])), r"(?U)^\s+|\s+$", ""))))
    return F.coalesce(F.array_max(sizes), F.lit(0))


def role_path(messages: Column) -> Column:
    return F.array_join(F.transform(messages, lambda m: F.coalesce(m["role"], F.lit("?"))), "->")


def with_system(messages: Column, prompt: Column, anywhere: bool = False) -> Column:
    """Put a system message first unless the first (or, with ``anywhere``, any) message is one."""
    has = F.exists(messages, lambda m: m["role"] == "system") if anywhere else F.coalesce(F.try_element_at(messages, F.lit(1))["role"] == "system", F.lit(False))
    system = F.array(F.struct(F.lit("system").alias("role"), prompt.alias("content")))
    return F.when(has, messages).otherwise(F.concat(system, messages))


def pair(user: Column, assistant: Column) -> Column:
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.array(message("user", user), message("assistant", assistant))


def from_conversations(turns: Column) -> Column:
    """Other names of roles and contents; turns that lack either are dropped."""
    role = lambda m: F.coalesce(m["role"], m["from"])
    named = F.transform(
        turns,
        lambda m: F.struct(
            F.when(role(m) == "human", "user").when(role(m) == "gpt", "assistant").otherwise(role(m)).alias("role"),
            F.coalesce(m["content"], m["value"]).alias("content"),
        ),
    )
    return F.filter(named, lambda m: (T.filled(m["role"]) != "") & (T.filled(m["content"]) != ""))


def question_with_options(question: Column, options: Column, letters: tuple[str, ...] = OPTION_LETTERS) -> Column:
    """The question and one line per letter; a missing option leaves its line empty."""
    lines = [F.concat(F.lit(f"{x}) "), F.coalesce(F.try_element_at(options, F.lit(x)), F.lit(""))) for x in letters]
    return F.concat_ws("\n", question, *lines)


def dispatch(row: Column) -> Column:
    """Messages of a record by the first shape that it has: messages, conversations, instruction/output, prompt/response,
    question/answer (with options if there are any), user/assistant. Null if it has none."""
    c = lambda name: row.getField(name)
    has = lambda *names: F.forall(F.array(*[c(n) for n in names]), lambda x: x.isNotNull())
    with_input = F.when(T.filled(c("input")) != "", F.concat(c("instruction"), F.lit("\n"), c("input"))).otherwise(c("instruction"))
    asked = F.when(c("options").isNotNull(), question_with_options(c("question"), c("options"))).otherwise(c("question"))
    return (
        F.when(c("messages").isNotNull(), c("messages"))
        .when(c("conversations").isNotNull(), from_conversations(c("conversations")))
        .when(has("instruction", "output"), pair(with_input, c("output")))
        .when(has("prompt", "response"), pair(c("prompt"), c("response")))
        .when(has("question", "answer"), pair(asked, c("answer")))
        .when(has("user", "assistant"), pair(c("user"), c("assistant")))
    )


def from_turns(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", content: str = "text") -> DataFrame:
    """One row per thread: row_id, n_messages, role_path, and the last and first texts of users and assistants.

    Texts are found by ordered aggregates that combine before the shuffle; only the roles of a thread are gathered.
    """
    pick = lambda f, who: F.coalesce(f(F.when(F.col(role) == who, T.filled(content)), F.when(F.col(role) == who, F.col(order))), F.lit(""))
    roles = F.transform(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.coalesce(F.col(role), F.lit("?")).alias("r")))), lambda x: x["r"])
    return turns.groupBy(F.col(key).alias("row_id")).agg(
        F.count(F.lit(1)).alias("n_messages"), F.array_join(roles, "->").alias("role_path"),
        *[pick(f, who).alias(f"{which}_{who}") for which, f in (("last", F.max_by), ("first", F.min_by)) for who in ("user", "assistant")],
    )
