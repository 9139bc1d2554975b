from collections import Counter

import numpy as np
import pytest

from corpuskit.llm import token_scan


def brute(rows):
    encode = token_scan.tokenizer(token_scan.VOCABULARY).encode_ordinary
    return Counter((d, len(encode(t or ""))) for d, t in rows)


def test_documents_and_odd_rows(documents, odd, none):
    for docs in (documents, odd):
        got = token_scan.count_tokens(docs).collect()
        assert Counter((r.doc_id, r.n_tokens) for r in got) == brute(docs.select("doc_id", "text").collect())
    assert token_scan.count_tokens(none).count() == 0


@pytest.mark.parametrize("block_bytes", [2, 6, 64, 1 << 20])
def test_blocks_are_stitched(spark, tmp_path, block_bytes):
    rng = np.random.default_rng(5)
    want = set()
    for k in range(4):
        ids = np.where(rng.random(300) < (0.0, 0.05, 0.3, 0.9)[k], 9, rng.integers(0, 9, 300)).astype("<u2")
        start = n = 0
        for i in np.flatnonzero(ids == 9).tolist():
            want.add((f"{k}.bin", n, start, i - start, True))
            start, n = i + 1, n + 1
        if start < 300:
            want.add((f"{k}.bin", n, start, 300 - start, False))
        (tmp_path / f"{k}.bin").write_bytes(ids.tobytes() + b"\x07" * (k % 2))
    (tmp_path / "empty.bin").write_bytes(b"")
    got = token_scan.scan_token_files(spark, f"file://{tmp_path}", end=9, block_bytes=block_bytes).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
