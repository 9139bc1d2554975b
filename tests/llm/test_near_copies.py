import re
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline

from corpuskit.llm import near_copies

SF = "/root/testdata/sf0.01"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
near_dedup = dict(corpus_pipeline.STAGES)["near_dedup"]


def brute_kept(rows):
    """doc_ids that stay of (doc_id, text): the smallest of each group linked by a five-word Jaccard similarity of 0.8."""
    rows = sorted(rows)
    sets, holders, root = [], defaultdict(list), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, text) in enumerate(rows):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))})
        shared = defaultdict(int)
        for s in sets[i]:
            for j in holders[s]:
                shared[j] += 1
            holders[s].append(i)
        for j, n in shared.items():
            if 5 * n >= 4 * (len(sets[i]) + len(sets[j]) - n):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [d for i, (d, _) in enumerate(rows) if find(i) == i]


def test_stage_removes_what_brute_force_does(spark, documents):
    got = sorted(r.doc_id for r in near_dedup(spark, documents, SF).collect())
    assert got == brute_kept([(r.doc_id, r.text) for r in documents.collect()])


@pytest.mark.parametrize("block", [near_copies.BLOCK_ROWS, 3])
def test_pairs_that_leaders_miss(spark, monkeypatch, block):
    """Chains in which each text is near to the next only, so that leaders are often not near to the others of a bucket."""
    monkeypatch.setattr(near_copies, "BLOCK_ROWS", block)
    rng = np.random.default_rng(5)
    texts = []
    for c in range(12):
        words = [f"c{c}w{k}" for k in range(200)]
        for _ in range(10):
            texts.append(" ".join(words))
            words = words[int(rng.integers(14, 24)) :] + [f"n{x}" for x in rng.integers(1 << 40, size=12)]
    rows = [(d, texts[k], "en", "s", 1) for d, k in enumerate(rng.permutation(len(texts)).tolist())]
    got = sorted(r.doc_id for r in near_dedup(spark, spark.createDataFrame(rows, DOCS), SF).collect())
    want = brute_kept([r[:2] for r in rows])
    assert 12 < len(want) < len(rows) and got == want
