"""The registry of benchmark tables: which fields hold the question and its options."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.functions import text as T
from corpuskit.sources.jsonl import with_row_ids

#: Shorter texts are no questions.
MIN_CHARS = 10


@dataclass(frozen=True)
class Layout:
    question: str
    options: tuple[str, ...] = ()
    choices: str | None = None
    splits: tuple[str, ...] = ("test",)


#: Field names of the public benchmark tables.
REGISTRY = {
    "arabic_mmlu": Layout("Question", ("Option 1", "Option 2", "Option 3", "Option 4")),
    "alghafa": Layout("query", ("sol1", "sol2", "sol3", "sol4", "sol5")),
    "aratrust": Layout("Question", ("A", "B", "C")),
    "arabic_exams": Layout("question", ("A", "B", "C", "D")),
    "arabic_mmmlu": Layout("question", choices="choices"),
    "alrage": Layout("question", splits=("train",)),
    "arabic_language_qa": Layout("Question", ("Option 1", "Option 2", "Option 3", "Option 4")),
}


def question_text(df: DataFrame, layout: Layout) -> Column:
    """The question with its options; if the field is missing, the first string of more than 20 characters."""
    if layout.question not in df.columns:
        strings = [F.col(f"`{f.name}`") for f in df.schema.fields if f.dataType.simpleString() == "string"]
        return F.coalesce(*[F.when(F.length(c) > 20, c) for c in strings]) if strings else F.lit(None).cast("string")
    q = T.filled(F.col(f"`{layout.question}`"))
    if layout.choices and layout.choices in df.columns:
        return T.options_text(q, F.coalesce(F.col(layout.choices), F.array().cast("array<string>")))
    there = [F.col(f"`{o}`").cast("string") for o in layout.options if o in df.columns]
    return T.options_text(q, F.array(*there)) if there else q


def questions(tables: dict[tuple[str, str, str], DataFrame]) -> DataFrame:
    """(benchmark, text, raw_question, config_name, index) of tables by (name, config, split).

    Unknown names and splits that the layout does not list are passed over; so are texts that are too short once collapsed. A table
    brings its own ``index`` or ``row_id``.
    """
    parts = []
    for (name, config, split), df in tables.items():
        layout = REGISTRY.get(name)
        if layout is None or split not in layout.splits:
            continue
        raw = question_text(df, layout)
        row = df.select(F.lit(name).alias("benchmark"), T.collapse(raw).alias("text"), T.preview(raw, 500).alias("raw_question"), F.lit(config).alias("config_name"), F.col("row_id").alias("index"))
        parts.append(row.where(F.length("text") >= MIN_CHARS))
    return reduce(DataFrame.unionByName, parts)


class Loaders:
    """Named providers of benchmark tables: callables (spark, config, split) -> DataFrame, or an iterable of texts."""

    def __init__(self):
        self.by_name: dict[str, object] = {}

    def register(self, name: str, loader) -> None:
        self.by_name[name] = loader

    def load(self, spark, wanted: list[tuple[str, str, str]]) -> dict[tuple[str, str, str], DataFrame]:
        """Tables of the (name, config, split) that have a loader, numbered as they come; the others are passed over."""
        out = {}
        for name, config, split in wanted:
            if name in self.by_name:
                made = self.by_name[name](spark, config, split)
                made = made if isinstance(made, DataFrame) else spark.createDataFrame([(k, t) for k, t in enumerate(made)], "row_id bigint, text string")
                out[name, config, split] = made if "row_id" in made.columns else with_row_ids(made)
        return out

    def texts(self, spark, wanted: list[tuple[str, str, str]]) -> DataFrame:
        """(benchmark, text) of all wanted tables, for decontamination: the layout's question, or any long text of a row."""
        parts = []
        for (name, _, _), df in self.load(spark, wanted).items():
            raw = question_text(df, REGISTRY.get(name, Layout("text")))
            parts.append(df.select(F.lit(name).alias("benchmark"), raw.alias("text")))
        return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], "benchmark string, text string")
