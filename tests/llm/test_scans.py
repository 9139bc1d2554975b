"""License scans, quality ledger and secret scan against plain Python over whole tables."""

import hashlib
import re
from collections import Counter

from corpuskit.llm import license_scan, quality_ledger, secret_scan


def licenses(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    starts, labels = [], set()
    for phrase, label in license_scan.PHRASES:
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        starts += at
        labels |= {label} if at else set()
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def check_licenses(docs):
    got = license_scan.digest(license_scan.scan_licenses(docs)).collect()
    want = Counter((r.doc_id, *licenses(r.text)) for r in docs.collect())
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == want
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)


def test_license_scan(documents, odd, none):
    check_licenses(documents)
    check_licenses(odd)
    assert license_scan.scan_licenses(none).count() == 0


def test_fuzzy_notices_take_a_few_edits():
    edited = "... Permission is hereby grantd, free of charge, to any persom obtaining a copy ..."
    n, hits = license_scan.scan_text(edited.encode())
    assert [(h[0], h[1], h[4]) for h in hits] == [("mit", "notice", 2)]
    assert hits[0][2:4] == (0, n - 1)
    assert license_scan.scan_text(b"permission was not given to persons without charge or copy")[1] == []
    assert license_scan.scan_text(None) == (0, [])


WS = r"[^\x20\x09-\x0D]+"


def quality(text):
    text = text or ""
    words = re.findall(WS, text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(WS, line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    twice = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(twice), n < 50 or 100 * len(twice) > 50 * n


def check_quality(docs):
    ledger = quality_ledger.apply_policy(quality_ledger.apply_policy(quality_ledger.build_ledger(docs), "web-2"), "base-1", "passed")
    got = ledger.collect()
    want = Counter((r.doc_id, *quality(r.text)) for r in docs.collect())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, not r.passed) for r in got) == want
    assert all(r.passed for r in got if r.kept)
    return ledger


def test_quality_ledger(documents, odd, none):
    check_quality(odd)
    ledger = check_quality(documents).cache()
    rows = ledger.collect()
    m = quality_ledger.mask("web-2")
    for r in quality_ledger.ablations(ledger, "web-2").collect():
        bit = quality_ledger.BITS[r.rule]
        assert r.n_failed == sum(x.failed & bit > 0 for x in rows)
        assert r.n_alone == sum(x.failed & m == bit for x in rows)
        assert r.n_kept_without == sum(x.failed & m & ~bit == 0 for x in rows)
    assert quality_ledger.build_ledger(none).count() == 0


def test_clean_labelled_documents_are_kept(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    good = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("quality = 1")
    ledger = quality_ledger.build_ledger(docs.join(good, "doc_id", "left_semi"))
    only_new = quality_ledger.mask("web-2") & ~quality_ledger.mask("base-1")
    assert ledger.where(ledger.failed.bitwiseAND(only_new) != 0).count() == 0


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def secrets(text):
    text = text or ""
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    joined = ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))
    count = Counter(s[3] for s in spans)
    return count["assign"], count["access"], count["hex"], hashlib.sha256(joined.encode()).hexdigest(), tuple(filter(None, joined.split(",")))


def check_secrets(docs):
    got = secret_scan.digest(secret_scan.scan_secrets(docs)).collect()
    want = Counter((r.doc_id, *secrets(r.text)[:4]) for r in docs.collect())
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == want
    by_sha = {secrets(r.text)[3]: secrets(r.text)[4] for r in docs.collect()}
    assert all(set(by_sha[r.base_sha256]) <= set(r.spans.split(",")) for r in got)


def test_secret_scan(documents, odd, none):
    check_secrets(documents)
    check_secrets(odd)
    assert secret_scan.scan_secrets(none).count() == 0


def test_many_spans_in_one_text(spark):
    text = " ".join(f"{k:016x} token={'ab1' * 4}{k}" for k in range(700))
    check_secrets(spark.createDataFrame([(1, text, "s")], "doc_id bigint, text string, source string"))


def test_ownership_separates_copies_from_live_keys(spark):
    live, copied = "q7Zk2mX9vB4nL1pR8sT5", "h3Jd8fK2lQ9wE4rT7yU1"
    rows = [(1, f"token = {live}", "ann/a"), (2, f"token = {live}", "ann/b")] + [(k, f"token = {copied}", f"o{k}/r") for k in range(3, 8)] + [(9, "password = example-password-1", "bob/x")]
    found = secret_scan.candidates(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))
    got = {r.hash: (r.verdict, r.n_owners, r.n_repos, r.n_found) for r in secret_scan.ownership(found).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert got[sha(live)] == ("live", 1, 2, 2)
    assert got[sha(copied)] == ("example", 5, 5, 5)
    assert got[sha("example-password-1")][0] == "example"


def test_bare_tokens_count_only_if_owner_specific(spark):
    live, copied = "q7Zk2mX9vB4nL1pR8sT5q7Zk2mX9vB4nLw", "h3Jd8fK2lQ9wE4rT7yU1h3Jd8fK2lQ9wEz"
    rows = [(1, f"see {live} here", "a/a")] + [(k, f"see {copied} here", f"o{k}/r") for k in range(2, 7)]
    got = secret_scan.digest(secret_scan.scan_secrets(spark.createDataFrame(rows, "doc_id bigint, text string, source string"))).collect()
    assert {r.doc_id: r.spans for r in got} == {1: "bare:4:38"} | {k: "" for k in range(2, 7)}


def test_long_texts_are_cut_at_spaces(documents):
    from corpuskit.llm import common, simhash

    text = " ".join(r.text for r in documents.limit(200).collect()).encode() + b"\x0b" + b"x" * 3000 + b"\n "
    for most in (1, 100, 5000, 1 << 30):
        assert b"".join(common.space_pieces(text, most)) == text
        assert [w for p in common.space_pieces(text, most) for w in p.split()] == text.split()
    assert common.one_spaced(text) == b" ".join(text.split()) and common.one_spaced(b" \n") == common.one_spaced(b"") == b""
    longer = text * 3  # more than a piece
    assert len(longer) > 1 << 20
    assert license_scan.scan_text(longer)[0] == licenses(longer.decode())[0]
    assert quality_ledger.measure(longer)[:5] == quality(longer.decode())[:5]
    from tests.llm.test_simhash import brute_print

    part = text[: 1 << 17].decode("utf-8", "ignore")  # more shingles than are hashed at a time
    assert simhash.fingerprint(part.encode()) == brute_print(part)
