"""Text columns: canonical forms, digests and classifiers. Everything but :func:`unicode_clean` is a built-in expression."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuskit.functions import patterns as P

ColumnLike = Column | str


def _c(x: ColumnLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def filled(x: ColumnLike) -> Column:
    """Missing and null texts count as empty."""
    return F.coalesce(_c(x), F.lit(""))


def collapse(x: ColumnLike) -> Column:
    """Runs of white space become one space; none is left at the ends."""
    return F.trim(F.regexp_replace(_c(x), P.rx(r"\s+"), " "))


def strip_think(x: ColumnLike) -> Column:
    """Without closed reasoning blocks; unclosed ones stay."""
    return F.regexp_replace(_c(x), P.rx(P.THINK, "s"), "")


def think_lengths(x: ColumnLike) -> Column:
    return F.transform(F.regexp_extract_all(_c(x), F.lit(P.rx(P.THINK, "s")), F.lit(1)), F.length)


def _folded(x: ColumnLike, punct: str) -> Column:
    """Letters folded, punctuation as ``punct``, vowel marks gone. All of these are beyond ASCII, so ASCII texts pass as they are."""
    text = _c(x)
    folded = F.translate(text, P.FOLD_FROM + P.PUNCT_FROM + P.DELETED, P.FOLD_TO + punct)
    return F.when(F.octet_length(text) == F.char_length(text), text).otherwise(F.regexp_replace(folded, P.TASHKEEL_CLASS, ""))


def canonical(x: ColumnLike) -> Column:
    """For exact dedup: letters folded, punctuation mapped to Latin, vowel marks gone, white space collapsed, lower case."""
    return F.lower(collapse(_folded(x, P.PUNCT_TO)))


def canonical_ngrams(x: ColumnLike) -> Column:
    """For n-grams: as :func:`canonical`, but punctuation becomes a space."""
    return collapse(F.lower(_folded(x, " " * len(P.PUNCT_FROM))))


def tokens(x: ColumnLike) -> Column:
    """Parts between spaces, without empty ones; for canonical texts."""
    return F.filter(F.split(_c(x), " "), lambda t: t != "")


def ngrams(words: Column, n: int) -> Column:
    """Neighbouring words joined by spaces; none if there are fewer than ``n``."""
    grams = F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.array_join(F.slice(words, i, F.lit(n)), " "))
    return F.when(F.size(words) >= n, grams).otherwise(F.array().cast("array<string>"))


def _unicode_cleaned(text: str) -> str:
    t = unicodedata.normalize("NFKC", text)
    for c in set(t):
        if not (c in "\n\t" or c.isprintable()):
            t = t.replace(c, "")
    return " ".join(t.split())


def clean_array(texts: pa.Array, most: int = 1 << 20) -> pa.Array:
    """:func:`unicode_clean` of an Arrow array, in slices of about ``most`` bytes: few texts are strings at a time."""
    out, begin, size = [], 0, 0
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    for k, n in enumerate([*lengths.tolist(), most]):
        size += n
        if size >= most:
            part = texts.slice(begin, k + 1 - begin).to_pylist()
            out.append(pa.array([None if t is None else _unicode_cleaned(t) for t in part], pa.string()))
            begin, size = k + 1, 0
    return pa.concat_arrays(out)


def unicode_clean(x: ColumnLike) -> Column:
    """NFKC, then only printable characters, line feeds and tabs, then collapsed. NFKC is no built-in: Arrow batches."""

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        return clean_array(texts)

    return clean(_c(x))


def n_arabic(x: ColumnLike) -> Column:
    return F.regexp_count(_c(x), F.lit(P.ARABIC_CLASS))


def n_latin(x: ColumnLike) -> Column:
    return F.regexp_count(_c(x), F.lit(P.LATIN_CLASS))


def arabic_ratio(x: ColumnLike) -> Column:
    """Arabic letters over Arabic and Latin ones; 0 without letters."""
    a, b = n_arabic(x), n_latin(x)
    return F.when(a + b > 0, a / (a + b)).otherwise(F.lit(0.0))


def language(x: ColumnLike) -> Column:
    a, b = n_arabic(x), n_latin(x)
    ratio = a / (a + b)
    return F.when(a + b == 0, "other").when(ratio >= 0.85, "arabic").when(ratio <= 0.15, "english").otherwise("mixed")


def is_mcq(x: ColumnLike) -> Column:
    """Profile rule: a line option, or two markers, or a keyword with a marker."""
    t = _c(x)
    marks = F.regexp_count(t, F.lit(P.MCQ_ARABIC_MARK)) + F.regexp_count(t, F.lit(P.MCQ_LATIN_MARK))
    return t.rlike(P.MCQ_LINE_OPTION) | (marks >= 2) | (t.rlike(P.MCQ_KEYWORDS) & (marks >= 1))


def is_mcq_broad(x: ColumnLike) -> Column:
    """Sampler rule: any of eleven patterns."""
    return any_of(x, P.MCQ_BROAD)


def is_mcq_line(x: ColumnLike) -> Column:
    """Filter rule: one line option."""
    return _c(x).rlike(P.MCQ_LINE_OPTION)


def any_of(x: ColumnLike, patterns) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | _c(x).rlike(p)
    return out


def topics(x: ColumnLike) -> Column:
    """Names of the sampler's topics that a text touches, in order."""
    return F.array_compact(F.array(*[F.when(_c(x).rlike(p), name) for name, p in P.TOPICS.items()]))


def fingerprints(user: ColumnLike, assistant_clean: ColumnLike) -> Column:
    """Names of the benchmarks whose patterns match the user's text or the assistant's without reasoning, in order."""
    return F.array_compact(F.array(*[F.when(any_of(user, f.user) | any_of(assistant_clean, f.assistant), name) for name, f in P.FINGERPRINTS.items()]))


def mentions(user: ColumnLike, assistant_clean: ColumnLike) -> Column:
    return F.concat_ws(" ", filled(user), filled(assistant_clean)).rlike(P.MENTION)


def leaks_rubric(assistant_clean: ColumnLike) -> Column:
    return any_of(assistant_clean, P.RUBRIC)


def orthography(x: ColumnLike) -> dict[str, Column]:
    t = _c(x)
    return {
        "has_alef_variants": t.rlike(f"[{P.ALEF_VARIANTS}]"), "has_ta_marbuta": t.contains(P.TA_MARBUTA),
        "has_alef_maksura": t.contains(P.ALEF_MAKSURA), "has_tashkeel": t.rlike(P.TASHKEEL_CLASS),
    }


def wrappers(x: ColumnLike) -> Column:
    return F.array_compact(F.array(*[F.when(_c(x).contains(w), F.lit(w)) for w in P.ANSWER_WRAPPERS]))


def has_code(x: ColumnLike) -> Column:
    return _c(x).contains("```")


def has_url(x: ColumnLike) -> Column:
    return _c(x).rlike(P.rx("https?://"))


def answer_letter(x: ColumnLike, compat: bool = True) -> Column:
    """The option letter of an answer. ``compat``: the first option character anywhere wins, else a lone Latin A-E.

    Without ``compat`` the Arabic letter must stand alone, too.
    """
    t = F.trim(F.regexp_replace(_c(x), P.rx(r"^\s+|\s+$"), ""))
    arabic = F.regexp_extract(t, P.rx(P.ANSWER_LETTERS) if compat else P.rx(r"(?<![\p{L}\p{M}])(هـ|[أبجد])(?![\p{L}\p{M}])"), 0)
    latin = F.regexp_extract(t, P.rx(r"\b([A-E])\b"), 1)
    table = F.create_map(*[F.lit(v) for kv in P.LATIN_TO_ARABIC.items() for v in kv])
    return F.coalesce(F.nullif(arabic, F.lit("")), table[F.nullif(latin, F.lit(""))], t)


def digest(x: ColumnLike) -> Column:
    return F.sha2(_c(x), 256)


def pair_digest(a: ColumnLike, b: ColumnLike) -> Column:
    return F.sha2(F.concat(_c(a), F.lit("\u0000"), _c(b)), 256)


def gram_digest(x: ColumnLike) -> Column:
    return F.sha1(_c(x))


def preview(x: ColumnLike, n: int = 300) -> Column:
    return F.substring(_c(x), 1, n)


def for_embedding(x: ColumnLike, most: int = 5_000) -> Column:
    """Collapsed, and cut to what an embedding model takes."""
    return F.substring(collapse(x), 1, most)


def fill_template(template: ColumnLike, topic: ColumnLike, difficulty: ColumnLike, focus: ColumnLike) -> Column:
    t = F.replace(_c(template), F.lit("{topic}"), _c(topic))
    t = F.replace(t, F.lit("{difficulty}"), _c(difficulty))
    return F.replace(t, F.lit("{focus}"), F.array_join(_c(focus), "، "))


def options_text(question: ColumnLike, options: ColumnLike) -> Column:
    """The question and its options, each after its letter; an empty option is passed over but keeps its letter."""
    lines = F.transform(_c(options), lambda o, i: F.when(F.length(filled(o)) > 0, F.concat(F.char(F.lit(65) + i), F.lit(") "), o)))
    return F.array_join(F.concat(F.array(_c(question)), F.array_compact(lines)), "\n")


def json_object(x: ColumnLike) -> Column:
    """The outermost JSON object in a model's answer, null if there is none; code fences are removed first."""
    bare = F.regexp_replace(_c(x), r"(?m)^\x20*```[A-Za-z]*\x20*$", "")
    return F.nullif(F.regexp_extract(bare, P.rx(r"\{.*\}", "s"), 0), F.lit(""))


def category_of(run_name: ColumnLike) -> Column:
    return F.nullif(F.regexp_extract(_c(run_name), r"(?:subset|subject|category)=([^,]+)", 1), F.lit(""))


def task_of(class_name: ColumnLike, run_name: ColumnLike) -> Column:
    name = F.lower(F.replace(F.element_at(F.split(_c(class_name), r"\."), -1), F.lit("Scenario"), F.lit("")))
    return F.coalesce(F.nullif(name, F.lit("")), F.element_at(F.split(_c(run_name), ":"), 1))


def instance_index(instance_id: ColumnLike, position: ColumnLike) -> Column:
    return F.coalesce(F.replace(_c(instance_id), F.lit("id"), F.lit("")).try_cast("int"), _c(position).cast("int"))


def answer_format(mapping: ColumnLike, n_references: ColumnLike) -> Column:
    return F.when(F.coalesce(F.size(_c(mapping)), F.lit(0)) <= 0, "generation").otherwise(F.concat(F.lit("MCQ_"), _c(n_references).cast("string")))


def is_thinking_model(name: ColumnLike, effort: ColumnLike) -> Column:
    return F.lower(filled(name)).contains("thinking") | ~filled(effort).isin("", "off")
