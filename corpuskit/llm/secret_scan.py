"""Secret scans with corpus-wide ownership frequency. DataFrame operations only.

*Candidates.* Every kind is one Java pattern. Its matches (``regexp_extract_all``) and the text between them (``split``) alternate, so
running sums of their lengths give the spans in code points. Pieces are summed in two levels, in time linear in their number.

*Ownership.* Each candidate's value is hashed; hashes are counted over distinct owners and repositories. A value that many owners hold,
or that reads like a placeholder, is a copied ``example``; one that few owners hold and that has the mix of characters of a generated
key is ``live``; the rest is ``weak``. Bare tokens (no keyword near them) are reported only if they are live.

A repository is a document's ``source``; its owner is a column of its own if one is named, else the part before the first slash, and a
source without a slash is its own owner. A value that a third of all rows hold is
pre-aggregated by (value, owner, repository) before any shuffle, and the verdicts go back through a join whose size is checked.

Defined results: null texts are empty; null sources count as one owner; repeated rows each give a row; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuskit.llm.common import BROADCAST_ROWS, checked_join, staged, whole_row

#: (kind, pattern, group of the value, least length of the value); base kinds first, in the order of ties.
BASE = (
    ("assign", r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"(?<![0-9a-f])[0-9a-f]{16,}", 0, 16),
)
MORE = (
    ("vendor", r"gh[opsu]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+|-----BEGIN\x20[A-Z\x20]{0,20}PRIVATE\x20KEY-----", 0, 0),
    ("bare", r"""(?<![A-Za-z0-9+/_.-])(?=[A-Za-z0-9+/_-]{32})(?=[a-z_/+-]*[A-Z0-9])(?=[0-9a-f]*[A-Zg-z_/+-])(?=[^0-9]{0,31}[0-9])(?<!(?i:password|passwd|secret|token|api_?key)["']?\x20{0,4}[:=]\x20{0,4}["']?)[A-Za-z0-9+/_-]{32,}""", 0, 0),
)
KINDS = BASE + MORE
#: What any match of a kind holds: literal characters, then a plain pattern. Texts without it are not searched further.
GATES = {
    "assign": ((":", "="), None),
    "access": (("AKIA",), None),
    "hex": ((), r"[0-9a-f]{16}"),
    "vendor": (("gho_", "ghp_", "ghs_", "ghu_", "xox", "sk_live_", "eyJ", "PRIVATE KEY"), None),
    "bare": ((), r"[0-9]"),
}
#: Values of this many owners or more are widely copied.
EXAMPLE_OWNERS = 3
PLACEHOLDER = r"(?i)example|sample|dummy|placeholder|changeme|your[_-]?|xxxx|0{8}|1234567"
PIECES = 256
SPAN = "struct<start:int,end:int,value:string>"


def _running(matches: Column) -> Column:
    """array of (gap, hit, value) -> array of SPAN; gap is the length of the text before a match."""
    empty = F.array().cast(f"array<{SPAN}>")
    size = lambda x: x["gap"] + x["hit"]
    chunks = F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / PIECES).cast("int"))
    chunk = lambda i: F.slice(matches, i * PIECES + 1, F.lit(PIECES))
    totals = F.transform(chunks, lambda i: F.aggregate(chunk(i), F.lit(0), lambda s, x: s + size(x)))
    ints = F.array().cast("array<int>")
    bases = F.aggregate(
        totals, F.struct(F.lit(0).alias("s"), ints.alias("a")), lambda acc, x: F.struct((acc["s"] + x).alias("s"), F.concat(acc["a"], F.array(acc["s"])).alias("a")), lambda acc: acc["a"]
    )

    def inside(i: Column) -> Column:
        def add(acc, x):
            start = acc["s"] + x["gap"]
            span = F.struct(start.alias("start"), (start + x["hit"]).alias("end"), x["value"].alias("value"))
            return F.struct((acc["s"] + size(x)).alias("s"), F.concat(acc["a"], F.array(span)).alias("a"))

        return F.aggregate(chunk(i), F.struct(bases[i].alias("s"), empty.alias("a")), add, lambda acc: acc["a"])

    return F.when(F.size(matches) > 0, F.flatten(F.transform(chunks, inside))).otherwise(empty)


def _matches(text: Column, pattern: str, group: int, may: Column) -> Column:
    pairs = F.zip_with(
        F.split(text, pattern, -1),
        F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value")),
        lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m["hit"]).alias("hit"), m["value"].alias("value")),
    )
    none = F.array().cast("array<struct<gap:int,hit:int,value:string>>")
    return F.when(may & F.regexp(text, F.lit(pattern)), F.filter(pairs, lambda p: p["hit"].isNotNull())).otherwise(none)


def _may(text: Column, kind: str) -> Column:
    literals, pattern = GATES[kind]
    tests = [F.regexp(text, F.lit(pattern))] if pattern else []
    if literals:
        tests.insert(0, reduce(or_, [F.contains(text, F.lit(x)) for x in literals]))
    return reduce(and_, tests)


def candidates(docs: DataFrame, key: str = "doc_id", repo: str = "source", owner: str | None = None) -> DataFrame:
    """(rid, key, repo, owner, found): one row per document, ``found`` sorted by start, then kind; written, so that ids and spans stay."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    name = F.coalesce(F.col(repo).cast("string"), F.lit(""))
    holder = F.substring_index(name, "/", 1) if owner is None else F.coalesce(F.col(owner).cast("string"), F.lit(""))
    rows = docs.select(F.col(key), name.alias("repo"), holder.alias("owner"), text.alias("text"))
    for kind, pattern, group, _ in KINDS:
        rows = rows.withColumn(f"m_{kind}", _matches(F.col("text"), pattern, group, _may(F.col("text"), kind)))
    rows = rows.drop("text")
    parts = []
    for no, (kind, _, _, least) in enumerate(KINDS):
        rows = rows.withColumn(f"s_{kind}", _long_enough(_running(F.col(f"m_{kind}")), least)).drop(f"m_{kind}")
        parts.append(_named(F.col(f"s_{kind}"), no, kind))
    rows = rows.withColumn("found", F.array_sort(F.concat(*parts)))
    described = F.transform(
        "found",
        lambda s: F.struct(
            s["start"].alias("start"), s["no"].alias("no"), s["end"].alias("end"), s["kind"].alias("kind"), F.sha2(s["value"].cast("binary"), 256).alias("hash"), looks(s["value"]).alias("looks"),
        ),
    )
    out = rows.select(F.monotonically_increasing_id().alias("rid"), key, "repo", "owner", described.alias("found"))
    return staged(out, "secrets")


def _long_enough(spans: Column, least: int) -> Column:
    return F.filter(spans, lambda s: F.length(s["value"]) >= least)


def _named(spans: Column, no: int, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(no).alias("no"), s["end"].alias("end"), F.lit(kind).alias("kind"), s["value"].alias("value")))


def looks(value: Column) -> Column:
    """How a value reads: placeholder, generated (letters and digits, at least 8 different characters), or plain."""
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(value, ""))) >= 8)
    return F.when(value.rlike(PLACEHOLDER), "placeholder").when(mixed, "generated").otherwise("plain")


def ownership(found: DataFrame) -> DataFrame:
    """(hash, looks, n_docs, n_repos, n_owners, verdict) of every candidate value in the corpus."""
    each = found.select("repo", "owner", F.explode("found").alias("s")).groupBy(F.col("s.hash").alias("hash"), F.col("s.looks").alias("looks"), "owner", "repo").agg(F.count(F.lit(1)).alias("n"))
    by_owner = each.groupBy("hash", "looks", "owner").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("repos"))
    by_value = by_owner.groupBy("hash", "looks").agg(F.sum("n").alias("n_found"), F.sum("repos").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"))
    verdict = F.when((F.col("n_owners") >= EXAMPLE_OWNERS) | (F.col("looks") == "placeholder"), "example").when(F.col("looks") == "generated", "live").otherwise("weak")
    return by_value.withColumn("verdict", verdict)


def scan_secrets(docs: DataFrame, key: str = "doc_id", repo: str = "source", owner: str | None = None) -> DataFrame:
    """One row per document: ``key`` and ``spans``, an array of (start, no, end, kind, hash, verdict, n_owners, n_repos)."""
    found = candidates(docs, key, repo, owner)
    known = staged(ownership(found).select("hash", "verdict", "n_owners", "n_repos"), "ownership")
    each = found.where(F.size("found") > 0).select("rid", F.explode("found").alias("s")).select("rid", "s.start", "s.no", "s.end", "s.kind", F.col("s.hash").alias("hash"))
    judged = checked_join(each, known, ["hash"], "inner", known.count(), "rid").where((F.col("kind") != "bare") | (F.col("verdict") == "live"))
    spans = judged.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("start", "no", "end", "kind", "hash", "verdict", "n_owners", "n_repos"))).alias("spans"))
    kind = dict(spans.dtypes)["spans"]
    clean = found.where(F.size("found") == 0).select(key, F.array().cast(kind).alias("spans"))
    held = found.where(F.size("found") > 0).select("rid", key).join(spans, "rid", "left").select(key, F.coalesce("spans", F.array().cast(kind)).alias("spans"))
    return clean.unionByName(held)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(scanned: DataFrame) -> DataFrame:
    """The contract's columns from :func:`scan_secrets`."""
    base = F.filter("spans", lambda s: s["no"] < len(BASE))
    count = lambda field, value: F.size(F.filter("spans", lambda s: s[field] == value)).cast("bigint")
    return scanned.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        *[count("kind", kind).alias(f"n_{kind}") for kind, *_ in BASE],
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
        *[count("verdict", v).alias(f"n_{v}") for v in ("live", "example")],
    )


def without_live_secrets(docs: DataFrame, kinds: tuple[str, ...] = tuple(kind for kind, *_ in KINDS)) -> DataFrame:
    """The documents, less those that hold a live-looking credential of few owners. Widely copied examples and weak values stay."""
    rows = docs.select(whole_row(docs).alias("row"), "text", "source", F.struct(F.xxhash64("doc_id", "text").alias("a"), F.xxhash64("text", F.lit(1)).alias("b")).alias("key"))
    live = scan_secrets(rows, key="key", repo="source").where(F.exists("spans", lambda s: (s["verdict"] == "live") & s["kind"].isin(*kinds))).select("key").distinct()
    live = staged(live, "live")
    few = F.broadcast(live) if live.count() <= BROADCAST_ROWS else live
    return rows.select("row", "key").join(few, "key", "left_anti").select("row.*")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet")))
