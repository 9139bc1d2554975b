import pytest

from corpuskit.operators import ngrams


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 13])
def test_overlaps_against_sets(spark, n):
    texts = ["a b c d e f g h i j k l m n", "x a b c d e f g h i j k l m", "A  b, c d e f g h i j k l m n", "a b", "", None, "a b a b a b a b a b a b a b a b", "z " * 30]
    rows = spark.createDataFrame(list(enumerate(texts)), "row_id long, text string")
    bench = spark.createDataFrame([("p", texts[0]), ("p", texts[6]), ("q", "h i j k l m n " * 2), ("q", None)], "benchmark string, text string")

    def grams(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}

    known = {b: set().union(*(grams(r.text) for r in bench.collect() if r.benchmark == b)) for b in "pq"}
    want = {(k, b, len(grams(t) & known[b])) for k, t in enumerate(texts) for b in "pq" if grams(t) & known[b]}
    got = {(r.row_id, r.benchmark, r.overlap) for r in ngrams.hits(rows, bench, n=n).collect()}
    assert got == want
    kept = {r.row_id for r in ngrams.decontaminated(rows, ngrams.hits(rows, bench, n=n)).collect()}
    assert kept == set(range(len(texts))) - {k for k, _, _ in want}


def test_only_passages_that_may_match_are_hashed(spark):
    """White space and case of every kind; a gram at the end of a text and one in the next text are no passage; texts in pieces."""
    gram = "un deux trois quatre cinq six sept huit neuf dix onze douze été"
    texts = [
        "Word " * 40, f"x y {gram.upper()} z", gram.replace(" ", " \n\x1f\t "), gram.replace(" ", "  "), gram[:30], gram[30:], f"été {gram}،{gram} fin", "w " * 60 + gram, None, "",
        gram.replace("deux", "de​ux"), gram.replace("deux", "deuxx"), "a" * 500 + f" {gram}s {gram} x",
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "row_id long, text string")
    bench = spark.createDataFrame([("p", gram), ("q", "too short"), ("q", None)], "benchmark string, text string")
    want = {(1, gram), (2, gram), (3, gram), (6, gram), (7, gram), (10, gram), (12, gram)}
    for most in (ngrams.SLICE_BYTES, 100, 16):
        found = ngrams.passages(rows, bench, "row_id", "text", most=most).collect()
        assert {tuple(r) for r in found} == want and len(found) == len(want) + 1  # twice in one text
    assert {tuple(r) for r in ngrams.hits(rows, bench).collect()} == {(k, "p", 1) for k, _ in want}
    assert ngrams.passages(rows, bench.where("benchmark = 'q'"), "row_id", "text").count() == 0


def test_a_large_benchmark_side_gives_the_same(spark, monkeypatch):
    rows = spark.createDataFrame([(k, " ".join(f"w{(k * 7 + i) % 50}" for i in range(40))) for k in range(30)], "row_id long, text string")
    bench = rows.where("row_id % 5 = 0").selectExpr("concat('b', row_id % 2) AS benchmark", "upper(text) AS text")
    few = {tuple(r) for r in ngrams.hits(rows, bench).collect()}
    monkeypatch.setattr(ngrams, "BROADCAST_ROWS", 0)
    assert few and few == {tuple(r) for r in ngrams.hits(rows, bench).collect()}
