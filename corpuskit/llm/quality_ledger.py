"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit for each failed rule, so policies (named,
versioned sets of rules) are applied, compared and ablated later with bitwise operations on one long, without reading texts again.

Defined results: a null text has no words; repeated rows each give a row; other columns of the input are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.llm.common import arrow_map, space_pieces, staged

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters")

#: name -> condition on the measurements that fails a document; the position is the bit. New rules are appended, never reordered.
RULES: dict[str, Column] = {
    "few_words": lambda: F.col("n_words") < 50,
    "repeated_windows": lambda: 100 * F.col("n_repeat_words") > 50 * F.col("n_words"),
    "symbols": lambda: 100 * F.col("n_symbols") > 25 * F.col("n_words"),
    "duplicate_lines": lambda: 100 * F.col("n_dup_lines") > 50 * F.col("n_lines"),
    "capitals": lambda: 100 * F.col("n_upper") > 60 * F.col("n_letters"),
    "long_words": lambda: F.col("word_chars") > 14 * F.col("n_words"),
    "short_words": lambda: F.col("word_chars") < 2 * F.col("n_words"),
}
BITS = {name: 1 << k for k, name in enumerate(RULES)}

#: version -> rules in force
POLICIES = {
    "base-1": ("few_words", "repeated_windows"),
    "web-1": ("few_words", "repeated_windows", "symbols", "duplicate_lines"),
    "web-2": ("few_words", "repeated_windows", "symbols", "duplicate_lines", "capitals", "long_words", "short_words"),
}

_SYMBOLS = b"#*$%&|<>"
_INNER = bytes(range(0x80, 0xC0))
_BLANK = b"\t\n\x0b\x0c\r "
_UPPER = bytes(range(0x41, 0x5B))
_LETTERS = _UPPER + bytes(range(0x61, 0x7B))


def word_ids(text: bytes) -> tuple[np.ndarray, int]:
    """The words of a text as numbers, equal words alike, and how many different ones there are."""
    ids: dict[bytes, int] = {}
    parts = [np.array([ids.setdefault(w, len(ids)) for w in piece.split()], np.int64) for piece in space_pieces(text)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64), len(ids)


def repeat_words(words: np.ndarray, different: int, window: int = 3) -> int:
    """Words that stand in a window of three found twice or more in the text."""
    n = len(words)
    if n < window + 1:
        return 0
    pair = words[:-1] * different + words[1:]
    if different > 2_000_000:  # three numbers no longer fit into 63 bits
        pair = np.unique(pair, return_inverse=True)[1].astype(np.int64)
    key = pair[:-1] * different + words[2:]
    _, back, count = np.unique(key, return_inverse=True, return_counts=True)
    twice = count[back] > 1
    covered = np.zeros(n, bool)
    for k in range(window):
        covered[k : n - window + 1 + k] |= twice
    return int(covered.sum())


def measure(text: bytes | None) -> tuple[int, ...]:
    text = text or b""
    size = len(text)
    words, different = word_ids(text)
    seen: set[bytes] = set()
    lines = dup = 0
    for line in text.split(b"\n"):
        if line.strip():
            lines += 1
            dup += line in seen
            seen.add(line)
    return (
        len(words), len(text.translate(None, _INNER + _BLANK)), size - len(text.translate(None, _SYMBOLS)), dup, repeat_words(words, different),
        lines, size - len(text.translate(None, _UPPER)), size - len(text.translate(None, _LETTERS)),
    )


def build_ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements, and ``failed``: bit k is set if rule k of ``RULES`` fails."""

    def run(columns):
        made = [measure(t) for t in columns["text"]]
        return {"doc_id": columns["doc_id"]} | {n: [m[k] for m in made] for k, n in enumerate(MEASURES)}

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    measured = arrow_map(source, "doc_id bigint, " + ", ".join(f"{n} bigint" for n in MEASURES), run)
    bits = [F.when(rule(), F.lit(BITS[name])).otherwise(F.lit(0)).cast("bigint") for name, rule in RULES.items()]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return measured.withColumn("failed", failed)


def mask(policy: str) -> int:
    return sum(BITS[r] for r in POLICIES[policy])


def apply_policy(ledger: DataFrame, policy: str, name: str = "kept") -> DataFrame:
    return ledger.withColumn(name, F.col("failed").bitwiseAND(F.lit(mask(policy)).cast("bigint")) == 0)


def ablations(ledger: DataFrame, policy: str) -> DataFrame:
    """For each rule of a policy: documents that fail it, that fail it alone (gained by dropping it), and kept without it.

    The ledger is first counted by its bits, so at most 2^rules rows are shuffled, whatever the corpus' size.
    """
    m = mask(policy)
    counts = ledger.groupBy(F.col("failed").bitwiseAND(F.lit(m).cast("bigint")).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BITS[r]).cast("bigint").alias("bit")) for r in POLICIES[policy]]))
    b = F.col("r.bit")
    fails, alone = F.col("bits").bitwiseAND(b) != 0, F.col("bits") == b
    return (
        counts.withColumn("r", rules).groupBy(F.col("r.rule").alias("rule"))
        .agg(*[F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("bigint").alias(x)
               for x, c in (("n_failed", fails), ("n_alone", alone), ("n_kept_without", alone | (F.col("bits") == 0)))])
        .withColumn("policy", F.lit(policy))
    )


def op9_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = build_ledger(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    out = apply_policy(apply_policy(ledger, "web-2"), "base-1", "passed")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~F.col("passed")).alias("base_failed"), "kept", "failed")


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of every policy fails, fails alone, and what is kept without it, over all documents."""
    ledger = staged(build_ledger(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("failed"), "ledger")
    return reduce(DataFrame.unionByName, [ablations(ledger, p) for p in POLICIES])


OP9_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
line AS (SELECT rid, unnest(string_split(t, chr(10))) AS x FROM d),
lines AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup_lines FROM line WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY rid),
start AS (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w),
gram AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, list_slice(ws, i, i + 2)) AS c FROM start),
place AS (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM gram WHERE c > 1),
twice AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM place GROUP BY rid),
m AS (
  SELECT doc_id, len(ws) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper, length(t) - length(regexp_replace(t, '[A-Za-z]', '', 'g')) AS n_letters
  FROM w LEFT JOIN lines USING (rid) LEFT JOIN twice USING (rid)
), f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    CAST((n_words < 50) AS BIGINT) + 2 * CAST((100 * n_repeat_words > 50 * n_words) AS BIGINT) + 4 * CAST((100 * n_symbols > 25 * n_words) AS BIGINT)
    + 8 * CAST((100 * n_dup_lines > 50 * n_lines) AS BIGINT) + 16 * CAST((100 * n_upper > 60 * n_letters) AS BIGINT)
    + 32 * CAST((word_chars > 14 * n_words) AS BIGINT) + 64 * CAST((word_chars < 2 * n_words) AS BIGINT) AS failed
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, failed = 0 AS kept, failed FROM f
"""

ABLATIONS_SQL = OP9_SQL.rpartition("SELECT doc_id")[0] + " UNION ALL ".join(
    f"SELECT '{r}' AS rule, count(*) FILTER (failed & {BITS[r]} <> 0) AS n_failed, count(*) FILTER (failed & {mask(p)} = {BITS[r]}) AS n_alone, "
    f"count(*) FILTER (failed & {mask(p) & ~BITS[r]} = 0) AS n_kept_without, '{p}' AS policy FROM f"
    for p in POLICIES
    for r in POLICIES[p]
)
