import re
import tracemalloc
import unicodedata

import pyarrow as pa

from corpuskit.functions import text as T


def plainly(t):
    t = unicodedata.normalize("NFKC", t)
    return re.sub(r"\s+", " ", "".join(c for c in t if c in "\n\t" or c.isprintable())).strip()


def test_cleaning_is_that_of_single_characters():
    every = "".join(map(chr, [c for c in range(0x11000) if not 0xD800 <= c < 0xE000]))
    texts = [every[k : k + 97] for k in range(0, len(every), 97)] + ["", " \n\t ", "a b　c\x1cd", "x ­​y " * 50]
    texts.insert(3, None)
    want = [None if t is None else plainly(t) for t in texts]
    for most in (1, 500, 1 << 20):
        assert T.clean_array(pa.array(texts), most).to_pylist() == want
    assert T.clean_array(pa.array([], pa.string())).to_pylist() == []


def test_cleaning_holds_few_strings_at_a_time():
    texts = pa.array([f"ﬁ{k}" + "word " * 2_000 for k in range(2_000)])
    tracemalloc.start()
    T.clean_array(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10 << 20
