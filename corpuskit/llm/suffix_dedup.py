"""Removal of byte strings of ``window`` bytes or more that stand at two places of the corpus, by run-length indexes.

*Where windows meet.* A window is dealt by the least hash of its 128-byte grams, so equal windows always meet. Neighbouring windows
with one least gram form a segment; per text there is one for about every 140 bytes. A first pass counts least grams and drops
segments whose gram stands at one place only, without moving any text.

*Equal segments.* Segments that are equal byte for byte (copies, the inside of shared passages) repeat as a whole; they are counted by
hash, one of each is kept as representative, and none of the rest is moved.

*Different segments with one gram* are compared by their representatives. A task joins the segments of many grams to a text of about
``INDEX_BYTES``, builds a run-compressed Burrows-Wheeler transform with samples at the ends of its runs
(:class:`corpuskit.llm.repeat_index.RunIndex`), streams the matching statistics of all places from the samples, and marks matches of
``window`` or more. Grams with more than ``HOT_SEGMENTS`` different segments are not put into one index: their windows are counted by
a 128-bit hash, which combines before its shuffle.

*Passages.* Texts are also taken as rows of words, whatever the white space between them: the same steps with windows of ``words``
words mark passages that stand at two places. They are reported beside the removal and remove nothing. The lowest bit of a gram's hash
tells which of the two it belongs to.

*Removal.* Marks go back to all segments they stand for, and each text is cut once.

Defined results: null texts are empty; texts shorter than the window keep all bytes; equal rows (same doc_id and text) are two places,
so they lose all windows; strings are judged on the input, whatever else is removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.llm.common import BROADCAST_ROWS, arrow_map, as_list, drop_staged, slices, space_pieces, staged
from corpuskit.llm.repeat_index import GRAM, WORD_GRAM, gram_hashes, repeated_ranges, segments, word_hashes

WINDOW = 400
#: Words of a passage, at least.
WORDS = 50
INDEX_BYTES = 1 << 18
HOT_SEGMENTS = 1_024
#: Bytes that are hashed at a time; a longer text is taken in pieces that overlap by a window.
PIECE = 2 << 20
#: Bytes of segments that a task indexes, about.
TASK_BYTES = 4 << 20

SEGMENT = "v bigint, sh bigint, did bigint, t64 bigint, at bigint, windows int, twice boolean"
RANGES = "v bigint, sh bigint, ranges array<struct<a:bigint,b:bigint>>"
NO_ID = -(1 << 63)


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text")).withColumn("did", F.coalesce("doc_id", F.lit(NO_ID))).withColumn("t64", F.xxhash64("text"))


def _byte_parts(text: bytes, window: int) -> Iterator[tuple[np.ndarray, int]]:
    """(bytes, place of the first) in pieces that overlap by less than a window."""
    raw = np.frombuffer(text, np.uint8)
    for at in range(0, len(raw) - window + 1, PIECE):
        yield raw[at : at + PIECE + window - 1], at


def _word_parts(text: bytes, overlap: int) -> Iterator[tuple[np.ndarray, int]]:
    """(word hashes, number of the first) in pieces, each with ``overlap`` words of the piece before."""
    held, at = np.zeros(0, np.uint64), 0
    for piece in space_pieces(text, PIECE):
        units = np.concatenate((held, word_hashes(piece)))
        yield units, at
        held = units[max(0, len(units) - overlap) :]
        at += len(units) - len(held)


def _groups(parts: Iterator[tuple[np.ndarray, int, int]], most: int) -> Iterator[list[tuple[np.ndarray, int, int]]]:
    """Parts (units, place, text) side by side, about ``most`` units at a time."""
    group, size = [], 0
    for part in parts:
        if group and size + len(part[0]) > most:
            yield group
            group, size = [], 0
        group.append(part)
        size += len(part[0])
    if group:
        yield group


def _segments_of(window: int, words: int):
    import xxhash

    digest = xxhash.xxh3_64_intdigest

    def cut(group, ids, size: int, gram: int, level: int) -> pa.RecordBatch:
        data, ends = np.concatenate([g[0] for g in group]), np.cumsum([len(g[0]) for g in group])
        value, owner, first, count, twice = segments(data, ends, size, gram)
        raw, width = memoryview(data).cast("B"), data.itemsize
        sh = np.array([digest(raw[a:b]) for a, b in zip((first * width).tolist(), ((first + count + size - 1) * width).tolist())], np.uint64)
        text = np.array([g[2] for g in group])[owner]
        at = first - (ends - [len(g[0]) for g in group])[owner] + np.array([g[1] for g in group])[owner]
        value = value & ~np.uint64(1) | np.uint64(level)
        columns = value.view(np.int64), sh.view(np.int64), ids[0][text], ids[1][text], at.astype(np.int64), count.astype(np.int32), twice
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["v", "sh", "did", "t64", "at", "windows", "twice"])

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", PIECE):
                ids = part.column(1).to_numpy(), part.column(2).to_numpy()
                texts = as_list(part.column(0), True)
                for group in _groups(((u, at, k) for k, t in enumerate(texts) for u, at in _byte_parts(t, window)), PIECE):
                    yield cut(group, ids, window, GRAM, 0)
                if words:
                    for group in _groups(((u, at, k) for k, t in enumerate(texts) for u, at in _word_parts(t, words - 1) if len(u) >= words), PIECE >> 3):
                        yield cut(group, ids, words, WORD_GRAM, 1)

    return run


def _of_words(v: Column) -> Column:
    return v.bitwiseAND(F.lit(1).cast("bigint")) == 1


def _units(v: int, s: bytes) -> np.ndarray:
    """A segment's units from its bytes."""
    return np.frombuffer(s, np.uint64 if v & 1 else np.uint8)


def _strings_of(batches):
    """(text, wanted) -> the wanted segments' units: their bytes, or eight bytes for a word."""
    for batch in batches:
        v, sh, s = [], [], []

        def add(w, units):
            v.append(w["v"])
            sh.append(w["sh"])
            s.append(units)

        for text, wanted in zip(as_list(batch.column(0), True), batch.column(1).to_pylist()):
            by_word = sorted((w for w in wanted if w["v"] & 1), key=lambda w: w["at"] + w["size"])
            for w in wanted:
                if not w["v"] & 1:
                    add(w, text[w["at"] : w["at"] + w["size"]])
            k = 0
            for units, at in _word_parts(text, max(w["size"] for w in by_word)) if by_word else ():
                while k < len(by_word) and by_word[k]["at"] + by_word[k]["size"] <= at + len(units):
                    begin = by_word[k]["at"] - at
                    add(by_word[k], units[begin : begin + by_word[k]["size"]].tobytes())
                    k += 1
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()), pa.array(sh, pa.int64()), pa.array(s, pa.binary())], ["v", "sh", "s"])


def _indexed(window: int, words: int):
    """Segments sorted by gram -> marked ranges. An index takes the whole grams that fill INDEX_BYTES, of bytes or of words."""

    def flush(rows: list[tuple[int, int, bytes]]):
        found = repeated_ranges([_units(x, s) for x, _, s in rows], words if rows[0][0] & 1 else window)
        hit = [k for k, r in enumerate(found) if r]
        ranges = pa.array([[{"a": a, "b": b} for a, b in found[k]] for k in hit], pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))
        return pa.RecordBatch.from_arrays([pa.array([rows[k][0] for k in hit], pa.int64()), pa.array([rows[k][1] for k in hit], pa.int64()), ranges], ["v", "sh", "ranges"])

    def run(batches):
        held: tuple[list, list] = ([], [])
        size, last = [0, 0], None
        for batch in batches:
            for x, y, z in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if last is not None and (x, y) == last:  # a repeated row of the table
                    continue
                level = x & 1
                if size[level] >= INDEX_BYTES and x != held[level][-1][0]:
                    yield flush(held[level])
                    held[level].clear()
                    size[level] = 0
                held[level].append((x, y, z))
                size[level] += len(z)
                last = (x, y)
        for rows in held:
            if rows:
                yield flush(rows)

    return run


def _window_hashes(window: int, words: int):
    """Segments -> (v, sh, off, h1, h2) of their windows; a window is hashed by grams that cover it."""

    def run(batches):
        for batch in batches:
            for v, sh, s in zip(*(batch.column(k).to_pylist() for k in range(3))):
                size, gram = (words, WORD_GRAM) if v & 1 else (window, GRAM)
                g = gram_hashes(_units(v, s), gram)
                n = len(g) - size + gram
                h1, h2 = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
                for at in [*range(0, size - gram, gram), size - gram]:
                    part = g[at : at + n]
                    h1 = (h1 ^ part) * np.uint64(0x9E3779B97F4A7C15)
                    h1 ^= h1 >> np.uint64(31)
                    h2 = (h2 + part) * np.uint64(0xC2B2AE3D27D4EB4F)
                    h2 ^= h2 >> np.uint64(27)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, v)), pa.array(np.full(n, sh)), pa.array(np.arange(n)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))], ["v", "sh", "off", "h1", "h2"]
                )

    return run


def repeated_spans(docs: DataFrame, window: int = WINDOW, words: int = WORDS) -> DataFrame:
    """(did, t64, spans, passages): for each text with repeats, ranges (a, b) of its bytes and of its words, unmerged.

    ``docs`` comes from :func:`_rows`; without ``words`` there are no passages.
    """
    longest = F.octet_length("text") >= (min(window, 2 * words - 1) if words else window)
    cut = staged(docs.select("text", "did", "t64").where(longest).mapInArrow(_segments_of(window, words), SEGMENT), "segments")
    grams = cut.groupBy("v").agg(F.count(F.lit(1)).alias("n"), F.min("sh").alias("low"), F.max("sh").alias("high"), F.max("twice").alias("twice"))
    grams = grams.where((F.col("n") > 1) | F.col("twice")).select("v", ((F.col("low") != F.col("high")) | F.col("twice")).alias("mixed"))
    shared = staged(cut.drop("twice").join(grams, "v"), "shared-segments")
    drop_staged(cut)

    kinds = shared.groupBy("v", "sh").agg(F.count(F.lit(1)).alias("n"), F.max("windows").alias("windows"), F.max("mixed").alias("mixed"), F.min(F.struct("did", "t64", "at")).alias("rep"))
    kinds = staged(kinds, "segment-kinds")
    least = F.when(_of_words(F.col("v")), F.lit(words)).otherwise(F.lit(window))
    size = (F.col("windows") + least - 1).cast("bigint")
    marks = kinds.where("n > 1").select("v", "sh", F.array(F.struct(F.lit(0).cast("bigint").alias("a"), size.alias("b"))).alias("ranges"))

    mixed = kinds.where("mixed")
    held = size * F.when(_of_words(F.col("v")), F.lit(8)).otherwise(F.lit(1))
    by_gram = staged(mixed.groupBy("v").agg(F.count(F.lit(1)).alias("n"), F.sum(held).alias("bytes")), "mixed-grams")
    hot = by_gram.where(F.col("n") > HOT_SEGMENTS).select("v")
    n_hot, n_bytes = by_gram.agg(F.count_if(F.col("n") > HOT_SEGMENTS), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    wanted = mixed.select(F.col("rep.did").alias("did"), F.col("rep.t64").alias("t64"), F.struct("v", "sh", F.col("rep.at").alias("at"), size.alias("size")).alias("w"))
    wanted = wanted.groupBy("did", "t64").agg(F.collect_list("w").alias("wanted"))
    once = docs.groupBy("did", "t64").agg(F.first("text").alias("text"))  # repeated rows meet before the shuffle
    strings = once.join(wanted, ["did", "t64"]).select("text", "wanted").mapInArrow(_strings_of, "v bigint, sh bigint, s binary")
    cold, used = strings, [by_gram]
    if n_hot:
        strings = staged(strings.dropDuplicates(["v", "sh"]), "segment-texts")
        few = F.broadcast(hot) if n_hot <= BROADCAST_ROWS else hot
        cold = strings.join(few, "v", "left_anti")
        each = strings.join(few, "v", "left_semi").select("v", "sh", "s").mapInArrow(_window_hashes(window, words), "v bigint, sh bigint, off bigint, h1 bigint, h2 bigint")
        each = staged(each, "window-hashes")
        used += [strings, each]
        twice = each.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2")
        runs = each.join(twice, ["h1", "h2"]).select("v", "sh", "off").groupBy("v", "sh").agg(F.collect_list(F.struct(F.col("off").alias("a"), (F.col("off") + least).alias("b"))).alias("ranges"))
        marks = marks.unionByName(runs)
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // TASK_BYTES))
    indexed = cold.select("v", "sh", "s").repartition(tasks, "v").sortWithinPartitions("v", "sh").mapInArrow(_indexed(window, words), RANGES)
    marks = staged(marks.unionByName(indexed), "marks")
    for done in (kinds, *used):
        drop_staged(done)

    # a segment that many texts hold has many rows on the left and two at most on the right; adaptive execution splits the left
    moved = F.transform("ranges", lambda r: F.struct((r["a"] + F.col("at")).alias("a"), (r["b"] + F.col("at")).alias("b")))
    spans = shared.join(marks, ["v", "sh"]).select("did", "t64", moved.alias("ranges"), _of_words(F.col("v")).alias("by_word"))
    # the sets of repeated rows are those of one of them
    gathered = lambda of: F.flatten(F.collect_set(F.when(of, F.col("ranges"))))
    return spans.groupBy("did", "t64").agg(gathered(~F.col("by_word")).alias("spans"), gathered(F.col("by_word")).alias("passages"))


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            if b > out[-1][1]:
                out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, window: int = WINDOW, words: int = WORDS, keep_bytes: bool = True) -> DataFrame:
    """One row per document: doc_id, n_bytes, removed (maximal ranges of bytes), kept_sha256, passages (maximal ranges of words) and, if
    asked for, kept (the bytes left)."""
    rows = _rows(docs)
    joined = rows.join(repeated_spans(rows, window, words), ["did", "t64"], "left").select("doc_id", "text", "spans", "passages")

    def run(columns):
        out = {"doc_id": columns["doc_id"], "n_bytes": [], "removed": [], "kept_sha256": [], "passages": [], "kept": []}
        for text, spans, passages in zip(columns["text"], columns["spans"], columns["passages"]):
            gone = merged([(r["a"], r["b"]) for r in spans or ()])
            edges = [0, *(x for r in gone for x in r), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
            out["n_bytes"].append(len(text))
            out["removed"].append([{"a": a, "b": b} for a, b in gone])
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["passages"].append([{"a": a, "b": b} for a, b in merged([(r["a"], r["b"]) for r in passages or ()])])
            out["kept"].append(kept if keep_bytes else None)
        return out

    ranges = "array<struct<a:bigint,b:bigint>>"
    made = arrow_map(joined, f"doc_id bigint, n_bytes bigint, removed {ranges}, kept_sha256 string, passages {ranges}, kept binary", run)
    return made if keep_bytes else made.drop("kept")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns, and the passages of 50 words or more that stand at another place: their number and words."""
    done = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep_bytes=False)
    total = lambda ranges: F.aggregate(ranges, F.lit(0).cast("bigint"), lambda s, r: s + r["b"] - r["a"])
    count = lambda ranges: F.size(ranges).cast("bigint")
    return done.select(
        "doc_id", "n_bytes", total("removed").alias("n_removed"), count("removed").alias("n_spans"), "kept_sha256",
        count("passages").alias("n_passages"), total("passages").alias("n_passage_words"),
    )
