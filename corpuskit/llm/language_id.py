"""Language ID for mixed-language text.

*Fit.* Character trigrams of labelled documents are counted per language into a table of hashed buckets and turned into
smoothed log-probabilities; the scripts that a language uses are learned too. Every label is learned. The sample is bounded by
``ROWS_PER_LANGUAGE`` documents of each language (a documented parameter; chosen by a hash of doc_id); only the counts, at most
languages x buckets rows, reach the driver. A table has 2^``BUCKET_BITS`` buckets, and beyond 512 languages as many as ``MODEL_BYTES`` allow.

*Predict.* Words are runs of letters. The script range of a word narrows its candidate languages, each candidate scores the word by
its trigrams, and a Viterbi pass with a penalty for every change of language labels the words. All documents of a slice advance in
step, one vector operation per word position; scores are held for ``SCORE_BYTES`` at a time. A text beyond that goes through a
:class:`Trellis`, which takes it piece by piece and settles its words wherever all paths meet. The prediction is the language of most
letters, the score its share of them.

Defined results: null texts and texts without a letter give ``und`` and score 0; a null doc_id counts as not held out and is never
learned from; repeated rows each give a row; an empty table, or one without labels, gives ``und`` throughout.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.llm.common import arrow_extend

BUCKET_BITS, LEAST_BITS = 15, 10
ROWS_PER_LANGUAGE = 4_000
#: Size of the table of log-probabilities that tasks are sent; 2^LEAST_BITS buckets for each of 16,384 languages fill it, more are an error.
MODEL_BYTES = 64 << 20
#: Word scores that a task holds at a time, about.
SCORE_BYTES = 32 << 20
SWITCH_PENALTY = 12.0
#: Bytes whose letters are held at a time.
PIECE = 1 << 20
#: A language keeps a script if at least this share of its letters is of it.
SCRIPT_SHARE = 0.02

#: First code point of each script range and its script; fixed values of the Unicode block layout.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"), (0x0600, "arabic"),
    (0x0700, "other"), (0x0750, "arabic"), (0x0780, "other"), (0x08A0, "arabic"), (0x0900, "devanagari"), (0x0980, "bengali"),
    (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "other"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"),
    (0x0D00, "malayalam"), (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x1400, "other"), (0x1780, "khmer"), (0x1800, "mongolian"),
    (0x18B0, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"),
    (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"), (0x3190, "han"), (0x31F0, "kana"), (0x3200, "han"), (0xA000, "other"),
    (0xA720, "latin"), (0xA800, "other"), (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"), (0xFB00, "latin"),
    (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFE70, "arabic"), (0xFF00, "latin"), (0xFF66, "kana"),
    (0xFFA0, "hangul"), (0x10000, "other"), (0x20000, "han"), (0x30000, "other"),
)
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
_STARTS = np.array([a for a, _ in SCRIPTS])
_IDS = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS])


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter; those past the last assigned plane of letters share a false entry."""
    return np.array([chr(c).isalpha() for c in range(0x33480)] + [False])


@dataclass
class Words:
    """The words of several texts: ``grams`` and ``begins`` index letters, ``doc`` is the text of each word."""

    grams: np.ndarray
    begins: np.ndarray
    sizes: np.ndarray
    scripts: np.ndarray
    doc: np.ndarray


def cut(texts: list[bytes | None], bits: int = BUCKET_BITS) -> Words:
    plain = [(t or b"").decode("utf-8", "replace").lower() for t in texts]
    codes = np.frombuffer(("\n" + "\n".join(plain) + "\n").encode("utf-32-le", "replace"), np.uint32).copy()
    table = _letters()
    letter = table[np.minimum(codes, len(table) - 1)]
    owner_ends = np.cumsum([len(t) + 1 for t in plain])
    codes[~letter] = 0
    at = np.flatnonzero(letter)
    mix = codes[at - 1] * np.uint32(0x9E3779B1) + codes[at] * np.uint32(0x85EBCA77) + codes[np.minimum(at + 1, len(codes) - 1)] * np.uint32(0xC2B2AE3D)
    mix ^= mix >> np.uint32(15)
    mix *= np.uint32(0x2C1B3C6D)
    grams = (mix >> np.uint32(32 - bits)).astype(np.int32)
    begins = np.flatnonzero(~letter[at - 1]) if len(at) else np.zeros(0, np.int64)
    first = at[begins]
    scripts = _IDS[np.searchsorted(_STARTS, codes[first], "right") - 1] if len(first) else np.zeros(0, np.int64)
    doc = np.searchsorted(owner_ends, first - 1, "right")
    return Words(grams, begins, np.diff(begins, append=len(at)), scripts, doc)


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # buckets x languages, log-probabilities less their mean
    allowed: np.ndarray  # scripts x languages

    @property
    def bits(self) -> int:
        return len(self.weights).bit_length() - 1


def bucket_bits(languages: int) -> int:
    bits = min(BUCKET_BITS, (MODEL_BYTES // (4 * max(1, languages))).bit_length() - 1)
    if bits < LEAST_BITS:
        raise ValueError(f"{languages} languages are too many for a table of {MODEL_BYTES} bytes")
    return bits


def pieces(texts: list[bytes | None], most: int) -> list[list[tuple[bytes, int]]]:
    """(bytes, text index) in groups of about ``most`` bytes. A longer text is cut at spaces; a word beyond all bounds is cut itself."""
    groups: list[list[tuple[bytes, int]]] = [[]]
    size = 0
    for k, t in enumerate(texts):
        at, t = 0, t or b""
        while at < len(t):
            end = at + most
            if end < len(t):
                space = max(t.rfind(c, at + 1, end) for c in (b" ", b"\n"))
                end = space if space > 0 else end
                while end < len(t) and t[end] & 0xC0 == 0x80:  # not inside of a character
                    end += 1
            part = t[at:end]
            if groups[-1] and size + len(part) > most:
                groups.append([])
                size = 0
            groups[-1].append((part, k))
            size += len(part)
            at += len(part)
    return groups


def word_scores(words: Words, model: Model) -> np.ndarray:
    if not len(words.begins):
        return np.zeros((0, len(model.languages)), np.float32)
    scores = np.add.reduceat(model.weights[words.grams], words.begins, axis=0)
    return np.where(model.allowed[words.scripts], scores, scores.min(axis=1, keepdims=True) - 50.0).astype(np.float32)


def label(scores: np.ndarray, doc: np.ndarray, n_docs: int, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """The best language of each word under the switching penalty. ``doc``: the text of each word, ascending."""
    if not len(scores):
        return np.zeros(0, np.int64)
    k = scores.shape[1]
    n_words = np.bincount(doc, minlength=n_docs)
    starts = np.cumsum(n_words) - n_words
    own = scores.argmax(axis=1)
    out = own.copy()
    # a text whose words all prefer one language needs no pass: no path beats the one that takes every word's maximum
    varied = np.zeros(n_docs, bool)
    varied[doc[own != own[starts[doc]]]] = True
    order = np.flatnonzero(varied)
    order = order[np.argsort(-n_words[order], kind="stable")]
    if not len(order):
        return out
    sizes, begin = n_words[order], starts[order]
    steps = int(sizes[0])
    active = np.searchsorted(-sizes, -np.arange(steps), "left")  # texts with more than t words
    stay = np.zeros((len(scores), k), bool)
    best = np.zeros(len(scores), np.int16)
    value = scores[begin].astype(np.float64)
    for t in range(1, steps):
        n = active[t]
        v = value[:n]
        top = v.argmax(axis=1)
        jump = v[np.arange(n), top][:, None] - penalty
        at = begin[:n] + t
        keep = v >= jump
        stay[at], best[at] = keep, top
        value[:n] = np.where(keep, v, jump) + scores[at]
    state = value.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        n = active[t]
        at = begin[:n] + t
        out[at] = state[:n]
        if t:
            kept = stay[at, state[:n]]
            state[:n] = np.where(kept, state[:n], best[at])
    return out


class Trellis:
    """The same labels for one text that comes piece by piece.

    Back pointers take a bit per word and language; they are held only since the last word at which all paths meet, which is wherever
    one language leads all others by more than the penalty.
    """

    def __init__(self, penalty: float = SWITCH_PENALTY):
        self.penalty, self.value = penalty, None
        self.settled: list[np.ndarray] = []
        self.stay: list[np.ndarray] = []
        self.best: list[int] = []

    def add(self, scores: np.ndarray) -> None:
        for row in scores.astype(np.float64):
            if self.value is None:
                self.value = row
                continue
            top = int(self.value.argmax())
            value = self.value - self.value[top]
            keep = value >= -self.penalty
            if keep.sum() == 1:
                self._settle(top)
            else:
                self.stay.append(np.packbits(keep))
                self.best.append(top)
            self.value = np.where(keep, value, -self.penalty) + row

    def _settle(self, state: int) -> None:
        out = [state]
        for stay, best in zip(reversed(self.stay), reversed(self.best)):
            state = state if stay[state >> 3] >> (7 - (state & 7)) & 1 else best
            out.append(state)
        self.settled.append(np.array(out[::-1], np.int64))
        self.stay.clear()
        self.best.clear()

    def path(self) -> np.ndarray:
        if self.value is None:
            return np.zeros(0, np.int64)
        self._settle(int(self.value.argmax()))
        self.value = None
        return np.concatenate(self.settled)


def _runs(path: np.ndarray, languages: list[str]) -> list[dict]:
    edge = np.flatnonzero(np.diff(path, prepend=-1)).tolist()
    return [{"first_word": a, "end_word": b, "lang": languages[path[a]]} for a, b in zip(edge, [*edge[1:], len(path)])]


def predict(texts: list[bytes | None], model: Model, spans: bool = False) -> dict[str, list]:
    n, k = len(texts), len(model.languages)
    out: dict[str, list] = {"lang_pred": ["und"] * n, "score": [0.0] * n, "spans": [[] for _ in range(n)]}
    if not k:
        return out
    most = max(1 << 12, min(PIECE, SCORE_BYTES // (4 * k)))
    held = max(most, 3 * (SCORE_BYTES // (4 * k)))  # a word has three bytes and a space at least, nearly always

    def note(i: int, letters: np.ndarray, path: np.ndarray) -> None:
        if not len(path):
            return
        held = np.bincount(path, letters, k)
        best = int(held.argmax())
        out["lang_pred"][i], out["score"][i] = model.languages[best], min(1.0, float(held[best] / held.sum()))
        if spans:
            out["spans"][i] = _runs(path, model.languages)

    def together(group: list[int]) -> None:
        made = []
        for part in pieces([texts[i] for i in group], most):
            words = cut([t for t, _ in part], model.bits)
            if len(words.begins):
                made.append((word_scores(words, model), words.sizes, np.array([d for _, d in part])[words.doc]))
        if not made:
            return
        scores, sizes, doc = (np.concatenate(x) for x in zip(*made))
        path = label(scores, doc, len(group))
        ends = np.cumsum(np.bincount(doc, minlength=len(group)))
        for i, a, b in zip(group, [0, *ends.tolist()], ends.tolist()):
            note(i, sizes[a:b], path[a:b])

    group: list[int] = []
    size = 0
    for i, t in enumerate(texts):
        length = len(t or b"")
        if length > held:
            trellis, letters = Trellis(), []
            for part in pieces([t], most):
                words = cut([x for x, _ in part], model.bits)
                if len(words.begins):
                    trellis.add(word_scores(words, model))
                    letters.append(words.sizes)
            if letters:
                note(i, np.concatenate(letters), trellis.path())
            continue
        if group and size + length > held:
            together(group)
            group, size = [], 0
        group.append(i)
        size += length + 64
    if group:
        together(group)
    return out


def fit(docs: DataFrame, usable: Column, rows_per_language: int = ROWS_PER_LANGUAGE) -> Model:
    """Learn from ``text`` and non-null ``lang`` of the documents for which ``usable`` holds."""
    docs = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    docs = docs.where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    counts = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MODEL_BYTES // (4 << LEAST_BITS) + 1).collect()}
    languages = sorted(counts)
    bits = bucket_bits(len(languages))
    buckets = 1 << bits
    if not languages:
        return Model([], np.zeros((buckets, 0), np.float32), np.zeros((len(SCRIPT_NAMES), 0), bool))
    share = docs.sparkSession.createDataFrame([(g, min(1.0, rows_per_language / n)) for g, n in counts.items()], "lang string, share double")
    docs = docs.join(F.broadcast(share), "lang")  # a row for each language
    sample = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 20)) < F.col("share") * (1 << 20)).select("lang", "text")
    index = {g: i for i, g in enumerate(languages)}

    def tally(batches):
        import pyarrow as pa

        from corpuskit.llm.common import as_list

        grams, scripts = np.zeros((len(index), buckets), np.uint32), np.zeros((len(index), len(SCRIPT_NAMES)), np.int64)
        for batch in batches:
            known = np.array([index[g] for g in batch.column(0).to_pylist()])
            for group in pieces(as_list(batch.column(1), True), PIECE):
                words = cut([t for t, _ in group], bits)
                if len(words.begins):
                    lang = known[np.array([k for _, k in group])[words.doc]]
                    slot, n = np.unique(np.repeat(lang, words.sizes) * buckets + words.grams, return_counts=True)
                    grams.ravel()[slot] += n.astype(np.uint32)
                    np.add.at(scripts, (lang, words.scripts), words.sizes)
        a, b = np.nonzero(grams)
        c, d = np.nonzero(scripts)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([a, c]), pa.int32()), pa.array(np.concatenate([b, -1 - d]), pa.int32()), pa.array(np.concatenate([grams[a, b].astype(np.int64), scripts[c, d]]), pa.int64())], ["lang", "slot", "n"])

    got = sample.mapInArrow(tally, "lang int, slot int, n bigint").groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow().to_pydict()
    grams, scripts = np.zeros((buckets, len(languages))), np.zeros((len(SCRIPT_NAMES), len(languages)))
    lang, slot, n = (np.array(got[c], np.int64) for c in ("lang", "slot", "n"))
    grams[slot[slot >= 0], lang[slot >= 0]] = n[slot >= 0]
    scripts[-1 - slot[slot < 0], lang[slot < 0]] = n[slot < 0]
    weights = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * buckets))
    weights -= weights.mean(axis=1, keepdims=True)
    allowed = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
    allowed |= ~allowed.any(axis=1, keepdims=True)  # a script that nobody uses leaves all candidates
    return Model(languages, weights.astype(np.float32), allowed)


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def identify(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), spans: bool = False) -> DataFrame:
    """``keep`` columns, lang_pred, score and, if asked for, the labelled spans (word positions, end exclusive)."""
    extra = ", spans array<struct<first_word:bigint,end_word:bigint,lang:string>>" if spans else ""
    return arrow_extend(docs, f"lang_pred string, score double{extra}", lambda texts: predict(texts, model, spans), keep=keep)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs, ~held_out())
    found = identify(docs, model, spans=True)
    return found.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), "lang_pred", "score", "spans")
