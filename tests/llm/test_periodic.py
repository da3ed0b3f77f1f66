import hashlib
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import EDGE, SF, docs_of, edge_docs, empty_docs
from tradewind.llm import periodic as P


def brute(words, most=None):
    """All runs by comparing the words at each distance."""
    n, out = len(words), {}
    for q in range(1, min(n // 4, most or n) + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                out.setdefault((i, j + q - i), q)  # the smallest period comes first
            i = j + 1
    return sorted((s, q, n) for (s, n), q in out.items())


WORDS = st.one_of(
    st.lists(st.sampled_from("ab"), max_size=60), st.lists(st.sampled_from("abc"), max_size=80),
    st.builds(lambda head, unit, times, part, tail: head + unit * times + unit[:part] + tail,
              st.lists(st.sampled_from("ab"), max_size=10), st.lists(st.sampled_from("aab"), min_size=1, max_size=30),
              st.integers(1, 7), st.integers(0, 30), st.lists(st.sampled_from("ab"), max_size=10)),
    st.builds(lambda u, a, v, b, times: ((u * a + v) * b) * times, st.lists(st.sampled_from("ab"), min_size=1, max_size=3), st.integers(1, 6),
              st.lists(st.sampled_from("abc"), max_size=4), st.integers(1, 3), st.integers(1, 6)))


@settings(max_examples=600, deadline=None)
@given(st.lists(WORDS, max_size=4))
def test_runs_equal_brute_force(texts):
    got = [[] for _ in texts]
    for doc, s, n, q in zip(*P.document_runs([[w.encode() for w in t] for t in texts]), strict=True):
        got[doc].append((s, q, n))
    assert got == [brute(t) for t in texts]


def test_all_short_texts_of_two_words():
    for n in range(13):
        texts = [[b"ab"[x >> i & 1:][:1] for i in range(n)] for x in range(1 << n)]
        got = [[] for _ in texts]
        for doc, s, length, q in zip(*P.document_runs(texts), strict=True):
            got[doc].append((s, q, length))
        assert got == [brute(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=60), st.data())
def test_wavelet_tree(values, data):
    tree = P.WaveletTree(np.array(values, dtype=np.int32))
    i = data.draw(st.integers(0, len(values)))
    j = data.draw(st.integers(i, len(values)))
    x, y = data.draw(st.integers(0, 90)), data.draw(st.integers(0, 90))
    want = sorted(v for v in values[i:j] if x <= v <= y)[:3]
    got = tree.successors(*[np.array([c]) for c in (i, j, x, y)], 3)
    assert [int(g[0]) for g in got] == want + [-1] * (3 - len(want))


def test_long_texts():
    texts = [[b"a"] * 50_000, [b"%d" % i for i in range(30_000)], ([b"x"] * 999 + [b"y"]) * 20]
    got = list(zip(*(c.tolist() for c in P.document_runs(texts)), strict=True))
    assert got == [(0, 0, 50_000, 1), *sorted([(2, 0, 20_000, 1000), *[(2, i * 1000, 999, 1) for i in range(20)]], key=lambda r: (r[1], r[3]))]


def digest(doc_id, text):
    """op11's row, by brute force."""
    words = [w.decode() for w in (text or "").encode().split()]
    n = len(words)
    if doc_id is not None and n and (h := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    top = min(runs, key=lambda r: (-Fraction(r[2], r[1]), r[0], r[1]), default=None)
    drop = {i for s, q, m in runs for i in range(s + q, s + m)}
    return (doc_id, len(runs), *((top[0], top[2], top[1], 1000 * top[2] // top[1]) if top else (None,) * 4),
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, q, m in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in drop).encode()).hexdigest())


def test_query_equals_brute_force(spark):
    rows = P.op11_periodic_runs(spark, SF).collect()
    texts = docs_of(spark)
    short = {i: t for i, t in texts.items() if len(t) < 40_000}
    assert {r.doc_id: tuple(r) for r in rows if r.doc_id in short} == {i: digest(i, t) for i, t in short.items()}
    assert len(rows) == len(texts) and any(r.n_runs for r in rows)


def test_edges(spark):
    out = P.periodic_runs(edge_docs(spark, "runs", "collapsed", "raw", "text_"), carry=["doc_id", "text", "runs", "collapsed", "raw"])
    rows = out.collect()
    assert len(rows) == len(EDGE) and out.columns == ["id", "n_words", "runs", "collapsed", "doc_id", "text", "runs", "collapsed", "raw"]
    for r in rows:
        words = (r[5] or "").split()
        assert r[1] == len(words) and r[4] == r[0] and r[8] == "clash"
        if len(words) < 5000:
            assert [(x.start, x.period, x.length) for x in r[2]] == brute(words)
    long = next(r for r in rows if r[0] == 6)
    assert [tuple(x) for x in long[2]] == [(0, 24_000, 6)] and bytes(long[3]) == b"long words and more of them"
    empty = P.periodic_runs(empty_docs(spark))
    assert empty.count() == 0 and empty.columns == ["id", "n_words", "runs", "collapsed"]
