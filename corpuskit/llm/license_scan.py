"""License scans: exact phrases, and short notices found with a bounded number of edits.

Texts are lower-cased (A-Z only) and cut into words. Two searches run over the whole word sequence:

* *phrases*: places where the words of a phrase stand consecutively; overlapping places count.
* *notices*: a notice that may hold ``k`` edits is cut into ``k + 1`` pieces. By the pigeonhole principle one piece stands unchanged
  in any match, so an automaton of all pieces gives every candidate place; the ``regex`` library's bounded-error matching then
  verifies the whole notice near that place and gives the span and the number of edits.

Both are map-side: no shuffle, no state between documents. Defined results: a null text counts as empty; repeated rows each give a
row; a null doc_id is kept; other columns of the input are ignored.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.llm.common import arrow_map, one_spaced

#: (phrase, label)
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: (label, notice in lower-case words, most edits in characters)
NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", 6),
    ("mit", "released under the mit license", 2),
    ("apache", "licensed under the apache license version 2 0", 3),
    ("apache", "you may not use this file except in compliance with the license", 5),
    ("gpl", "licensed under the gnu general public license", 3),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license", 7),
    ("lgpl", "under the terms of the gnu lesser general public license", 3),
    ("agpl", "under the terms of the gnu affero general public license", 3),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", 7),
    ("mpl", "subject to the terms of the mozilla public license", 3),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", 6),
    ("cc-by-nc", "licensed under cc by nc 4 0", 1),
    ("cc-by", "creative commons attribution", 2),
    ("proprietary", "all rights reserved", 1),
    ("unlicense", "this is free and unencumbered software released into the public domain", 5),
)

_BREAKS = bytes(c for c in range(0x80) if not (0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A))
_TO_SPACE = bytes.maketrans(_BREAKS, b" " * len(_BREAKS))

HITS = "doc_id bigint, n_words bigint, hits array<struct<label:string,method:string,first_word:bigint,last_word:bigint,edits:int,score:double>>"


def words_of(text: bytes) -> bytes:
    """Runs of digits, letters a-z (A-Z lowered) and everything beyond ASCII, with single spaces between them."""
    return one_spaced(text.lower().translate(_TO_SPACE))


@lru_cache(maxsize=8)
def _machine(notices: tuple):
    import ahocorasick
    import regex

    machine, seeds = ahocorasick.Automaton(), {}
    for k, (_, notice, edits) in enumerate(notices):
        cuts = [round(i * len(notice) / (edits + 1)) for i in range(edits + 2)]
        for a, b in zip(cuts, cuts[1:]):
            seeds.setdefault(notice[a:b], []).append((k, a))
    for seed, places in seeds.items():
        machine.add_word(seed, (len(seed), places))
    machine.make_automaton()
    rules = [regex.compile(rf"(?e)(?:{regex.escape(n, special_only=True, literal_spaces=True)}){{e<={e}}}") for _, n, e in notices]
    return machine, rules


def fuzzy_hits(line: str, notices: tuple = NOTICES) -> list[tuple[int, int, int, int]]:
    """(notice, begin, end, edits) of every verified place in a space-joined line of words; overlapping candidates are one window."""
    machine, rules = _machine(notices)
    windows: dict[int, list[tuple[int, int]]] = {}
    for end, (size, places) in machine.iter(line):
        begin = end + 1 - size
        for k, offset in places:
            _, notice, edits = notices[k]
            a, b = begin - offset - edits, begin - offset + len(notice) + edits
            windows.setdefault(k, []).append((max(0, a), b))
    found = []
    for k, spans in windows.items():
        joined: list[list[int]] = []
        for a, b in sorted(spans):
            if joined and a <= joined[-1][1]:
                joined[-1][1] = max(joined[-1][1], b)
            else:
                joined.append([a, b])
        for a, b in joined:
            for m in rules[k].finditer(line[a:b]):
                found.append((k, a + m.start(), a + m.end(), sum(m.fuzzy_counts)))
    return sorted(set(found), key=lambda x: (x[1], x[0], x[2]))


class Places:
    """Words before a place of a space-joined line, for places that mostly ascend: only what lies between is counted."""

    def __init__(self, line, space):
        self.line, self.space, self.at, self.n = line, space, 0, 0

    def __call__(self, at: int) -> int:
        if at < self.at:
            self.n -= self.line.count(self.space, at, self.at)
        else:
            self.n += self.line.count(self.space, self.at, at)
        self.at = at
        return self.n


def scan_text(text: bytes | None, phrases: tuple = PHRASES, notices: tuple = NOTICES) -> tuple[int, list[tuple]]:
    words = words_of(text or b"")
    n_words = words.count(b" ") + 1 if words else 0
    line = b" " + words + b" "
    hits = []
    for phrase, label in phrases:
        needle, n, place = b" " + phrase.encode() + b" ", phrase.count(" "), Places(line, b" ")
        at = line.find(needle)
        while at >= 0:
            first = place(at)
            hits.append((label, "phrase", first, first + n, 0, 1.0))
            at = line.find(needle, at + 1)
    if notices and n_words > 1:
        flat = line[1:-1].decode("utf-8", "replace")
        place = Places(flat, " ")
        for k, a, b, edits in fuzzy_hits(flat, notices):
            label, notice, _ = notices[k]
            while a < b and flat[a] == " ":
                a += 1
            while b > a and flat[b - 1] == " ":
                b -= 1
            hits.append((label, "notice", place(a), place(b), edits, 1.0 - edits / len(notice)))
    return n_words, hits


def scan_licenses(docs: DataFrame, phrases: tuple = PHRASES, notices: tuple = NOTICES) -> DataFrame:
    """One row per document: doc_id, n_words, hits (label, method, first_word, last_word, edits, score)."""

    def run(columns):
        scanned = [scan_text(t, phrases, notices) for t in columns["text"]]
        names = ("label", "method", "first_word", "last_word", "edits", "score")
        return {"doc_id": columns["doc_id"], "n_words": [n for n, _ in scanned], "hits": [[dict(zip(names, h)) for h in hits] for _, hits in scanned]}

    return arrow_map(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")), HITS, run)


def digest(scanned: DataFrame) -> DataFrame:
    """The contract's columns from :func:`scan_licenses`; ``notices`` holds label:first word:last word:edits of each fuzzy notice."""
    base = F.filter("hits", lambda h: h.method == "phrase")
    notices = F.filter("hits", lambda h: h.method == "notice")
    shown = F.transform(notices, lambda h: F.concat_ws(":", h.label, h.first_word, h.last_word, h.edits))
    labels = lambda hits: F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda h: h.label))), ",")
    first = F.array_min(F.transform(base, lambda h: h.first_word))
    last = F.array_max(F.transform(base, lambda h: h.first_word))
    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"), first.alias("first_word"), last.alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("hits")).alias("labels"),
        F.coalesce(F.array_max(F.transform("hits", lambda h: h.score)), F.lit(0.0)).alias("score"),
        F.size(notices).cast("bigint").alias("n_notices"), F.array_join(shown, ",").alias("notices"),
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet")))
