from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from corpuskit.llm import mixing


def fill(budget, children):
    """[(name, weight, capacity)] -> shares as fractions, by repeated rounds."""
    share, open_, left = {}, dict((n, (w, c)) for n, w, c in children), Fraction(min(budget, sum(c for *_, c in children)))
    while open_:
        level = left / sum(w for w, _ in open_.values())
        full = [n for n, (w, c) in open_.items() if c <= level * w]
        if not full:
            return share | {n: level * w for n, (w, _) in open_.items()}
        for n in full:
            share[n] = Fraction(open_[n][1])
            left -= open_.pop(n)[1]
    return share


def brute(leaves, total, weights, levels):
    """leaf path -> whole tokens; largest remainders first, ties by name."""
    budget, prefix = {(): total}, {()}
    for k, level in enumerate(levels):
        new = {}
        for parent in prefix:
            children = defaultdict(int)
            for path, capacity in leaves.items():
                if path[:k] == parent:
                    children[path[k]] += capacity
            rows = [(n, Fraction(weights.get(level, {}).get(n, 1)), c) for n, c in children.items()]
            exact = fill(budget[parent], rows)
            whole = {n: int(x) for n, x in exact.items()}
            due = min(budget[parent], sum(children.values())) - sum(whole.values())
            for n in sorted(exact, key=lambda n: (-(exact[n] - whole[n]), n))[:due]:
                whole[n] += 1
            new |= {(*parent, n): x for n, x in whole.items()}
        budget, prefix = new, set(new)
    return budget


CASES = [
    (dict(fraction=0.5, max_epochs=2), mixing.WEIGHTS), (dict(fraction=1.3, max_epochs=2), mixing.WEIGHTS), (dict(fraction=3.0, max_epochs=2), {}),
    (dict(total=777, max_epochs=1), {"lang": {"en": 1, "es": 50}}), (dict(total=0, max_epochs=1), {}),
]


@pytest.mark.parametrize("args, weights", CASES)
def test_documents(documents, args, weights):
    check(documents, args, weights)


@pytest.mark.parametrize("size", [1, 10**6])
def test_bucket_sizes_and_salted_joins(documents, monkeypatch, size):
    import corpuskit.llm.common as common

    monkeypatch.setattr(mixing, "BUCKET_ROWS", size)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    check(documents, *CASES[1])


def check(documents, args, weights):
    docs = mixing.with_levels(documents).select("doc_id", *mixing.LEVELS, "n_tokens")
    rows = docs.where("n_tokens > 0").collect()
    leaves, there = defaultdict(int), defaultdict(int)
    for r in rows:
        leaves[r.domain, r.lang, r.source] += r.n_tokens * args["max_epochs"]
        there[r.domain, r.lang, r.source] += r.n_tokens
    total = args.get("total", int(sum(there.values()) * args.get("fraction", 0)))
    want = brute(leaves, total, weights, mixing.LEVELS)
    got = mixing.mix(docs, mixing.LEVELS, "n_tokens", weights=weights, **args).collect()
    taken, by_epoch = defaultdict(int), defaultdict(dict)
    for r in got:
        leaf = r.domain, r.lang, r.source
        taken[leaf] += r.take_tokens
        by_epoch[leaf, r.epoch][r.doc_id] = r.take_tokens
    assert sum(taken.values()) == min(total, sum(leaves.values()))
    assert all(abs(taken[k] - want[k]) <= 1 for k in want)
    for leaf, n in want.items():
        own = {r.doc_id: r.n_tokens for r in rows if (r.domain, r.lang, r.source) == leaf}
        full, rest = divmod(taken[leaf], there[leaf])
        for e in range(full):
            assert by_epoch[leaf, e] == own
        if not rest:
            continue
        order = docs.sparkSession.createDataFrame([(full, d, t) for d, t in own.items()], "full bigint, doc_id bigint, n_tokens bigint") if leaf[2] == "src3" else None
        part = by_epoch[leaf, full]
        if order is not None:  # the prefix in the seeded order
            ids = [r.doc_id for r in order.orderBy(mixing.unit_hash(F.lit(42), "full", "doc_id", "n_tokens")).collect()]
            expect = {}
            for d in ids:
                if rest > 0:
                    expect[d] = min(rest, own[d])
                    rest -= own[d]
            assert part == expect
        else:
            assert sum(t != own[d] for d, t in part.items()) <= 1


def test_odd_rows(odd, none):
    docs = mixing.with_levels(odd)
    got = mixing.mix(docs, mixing.LEVELS, "n_tokens", fraction=1.0, max_epochs=1).collect()
    want = [r for r in mixing.with_levels(odd).collect() if r.n_tokens]
    assert sorted((str(r.doc_id), r.take_tokens) for r in got) == sorted((str(r.doc_id), r.n_tokens) for r in want)
    assert mixing.mix(mixing.with_levels(none), mixing.LEVELS, "n_tokens").count() == 0
    few = mixing.mix(docs, mixing.LEVELS, "n_tokens", total=50, max_epochs=1).collect()
    assert 50 <= sum(r.take_tokens for r in few) <= 51


def test_shortage_goes_to_siblings_first(spark):
    rows = [(i, d, g, s, n) for i, (d, g, s, n) in enumerate([("x", "a", "p", 10), ("x", "a", "q", 500), ("x", "b", "r", 500), ("y", "c", "t", 900)])]
    docs = spark.createDataFrame(rows, "doc_id bigint, domain string, lang string, source string, n bigint")
    got = {r.source: r.take_tokens for r in mixing.mix(docs, mixing.LEVELS, "n", total=800, max_epochs=1).collect()}
    # x and y get 400; in x, a and b get 200; p can give 10 of its 100, so q takes 190 and b is left alone
    assert got == {"p": 10, "q": 190, "r": 200, "t": 400}
