import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import EDGE, SF, docs_of, edge_docs, empty_docs
from tradewind.llm import fingerprint as P

TEXT = st.text(alphabet="ab\U0001f642é", max_size=40)


@settings(max_examples=100, deadline=None)
@given(TEXT, TEXT, st.integers(0, 40), st.integers(0, 40))
def test_spans_and_extensions(a, b, i, j):
    i, j = min(i, len(a)), min(j, len(b))
    x, y = P.PrefixHash(a), P.PrefixHash(b)
    n = 0
    while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
        n += 1
    assert x.common_extension(i, y, j) == n
    size = min(len(a) - i, len(b) - j)
    assert x.equal(i, y, j, size) == (a[i:i + size] == b[j:j + size])


@settings(max_examples=60, deadline=None)
@given(TEXT, TEXT, st.integers(0, 40), st.integers(0, 40))
def test_spliced_equals_hashing_the_text(a, b, k, m):
    k, m = min(k, len(a)), min(m, len(b))
    s = P.Spliced(P.PrefixHash(a), k, P.PrefixHash(b), m)
    assert P.fingerprint(s) == P.fingerprint(P.PrefixHash(a[:k] + b[:m]))


def test_likeness():
    a = P.fingerprint(P.PrefixHash("x" * 500 + "y" * 500))
    assert P.likeness(a, a) == 1.0
    half = P.likeness(a, P.fingerprint(P.PrefixHash("x" * 500 + "z" * 500)))
    assert 0.4 <= half <= 0.5
    assert P.likeness(a, P.fingerprint(P.PrefixHash("z" * 1000))) == 0.0
    assert P.likeness(P.fingerprint(P.PrefixHash("")), a) == 0.0


def _brute(docs):
    """Rows in order (doc_id, text) -> expected columns."""
    out = []
    for i, (rid, text) in enumerate(docs):
        nxt = docs[(i + 1) % len(docs)][1]
        h = len(text) // 2
        edited = text[:len(text) - h] + nxt[:h]
        f, e = P.fingerprint(P.PrefixHash(text)), P.fingerprint(P.PrefixHash(edited))
        out.append((rid, len(text), hashlib.sha256(edited.encode()).hexdigest(), f, e, P.likeness(f, e),
                    P.likeness(f, P.fingerprint(P.PrefixHash(nxt)))))
    return out


def test_query(spark):
    got = sorted(tuple(r) for r in P.op2_fingerprint(spark, SF).collect())
    assert got == _brute(sorted(docs_of(spark).items()))


def test_edge_rows(spark):
    rows = P.fingerprint_edits(edge_docs(spark, "bucket", "ghost", "tie", "b")).collect()
    assert len(rows) == len(EDGE)
    by_text = {}
    for rid, text in EDGE:
        by_text.setdefault(P.fingerprint(P.PrefixHash(text or "")), []).append(rid)
    assert sorted((r.fingerprint for r in rows)) == sorted(f for f, v in by_text.items() for _ in v)
    last = [r for r in rows if r.id == 9][0]  # followed by the first: a null id
    assert last.n_chars == 3000
    assert P.fingerprint_edits(empty_docs(spark)).count() == 0
    one = P.fingerprint_edits(edge_docs(spark).where("doc_id = 7")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0  # its own successor
