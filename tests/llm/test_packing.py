import random
from collections import Counter, defaultdict

from corpuskit.llm import packing


def naive(items, capacity, most):
    bins = []
    out = []
    for size, source, cluster in items:
        fits = [
            (b["left"], k) for k, b in enumerate(bins)
            if b["left"] >= size and (cluster is None or cluster not in b["clusters"]) and (source is None or b["sources"][source] < most)
        ]
        k = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append({"left": capacity, "clusters": set(), "sources": Counter()})
        b = bins[k]
        out.append((k, capacity - b["left"]))
        b["left"] -= size
        b["clusters"].add(cluster)
        b["sources"][source] += 1
    return out


def test_tightest_compatible_bin():
    rng = random.Random(0)
    for _ in range(300):
        items = [(rng.choice([0, 1, 3, 3, 7, rng.randint(0, 20)]), rng.choice([None, 0, 0, 1]), rng.choice([None, None, 0, 0, 1])) for _ in range(rng.randint(0, 60))]
        items.sort(key=lambda x: (-x[0], -1 if x[2] is None else x[2], -1 if x[1] is None else x[1]))
        assert packing.pack(items, 20, 3) == naive(items, 20, 3)


def check(docs, capacity=2048, **more):
    keyed = packing.with_keys(docs)
    want = keyed.collect()
    got = packing.pack_documents(keyed, "n_tokens", "source", "cluster", capacity, **more).collect()
    tokens = Counter()
    for r in got:
        tokens[r.doc_id] += r.n_tokens
    total = Counter()
    for r in want:
        total[r.doc_id] += r.n_tokens
    assert tokens == total
    assert Counter(r.doc_id for r in got if r.piece == 0) == Counter(r.doc_id for r in want)
    bins = defaultdict(list)
    for r in got:
        bins[r.shard, r.bin].append(r)
    by_id = {r.doc_id: r for r in want}
    for held in bins.values():
        at = 0
        for r in sorted(held, key=lambda r: (r.offset, r.n_tokens)):
            assert r.offset == at
            at += r.n_tokens
        assert at <= capacity
        ids = {r.doc_id for r in held}
        clusters = [by_id[d].cluster for d in ids if by_id[d].cluster is not None]
        assert len(clusters) == len(set(clusters))
        assert max(Counter(by_id[r.doc_id].source for r in held if by_id[r.doc_id].source is not None).values(), default=0) <= packing.MAX_PER_SOURCE
    return got, bins


def test_documents(documents):
    got, bins = check(documents)
    assert sum(r.n_tokens for r in got) > 0.9 * 2048 * (len(bins) - 1)
    check(documents, capacity=100, shard_items=150)


def test_odd_rows(odd, none):
    rows = odd.dropDuplicates(["doc_id"])
    check(rows, capacity=8)
    twice = packing.pack_documents(packing.with_keys(odd), "n_tokens", "source", "cluster", 8).where("doc_id = 4").collect()
    assert len({(r.shard, r.bin) for r in twice}) == 2  # equal rows are copies of each other
    assert packing.pack_documents(packing.with_keys(none), "n_tokens", "source", "cluster").count() == 0
