import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.helpers import EDGE, SF, edge_docs, empty_docs
from tests.llm.test_bpe import odd_texts
from tradewind.llm import alignment as A

TOK = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
TOK.encode_special_tokens = True
SP = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
VOCAB_A = {i: A.byte_level_bytes(t) for t, i in TOK.get_vocab().items() if i != 50256}


def encode(text):
    """Whole-text ids of both, or none."""
    if not text:
        return [], []
    a = TOK.encode(" " + text, add_special_tokens=False).ids
    b = SP.encode(text)
    raw = (" " + text).encode()
    spelled = b"".join(bytes([int(SP.id_to_piece(i)[3:5], 16)]) if SP.is_byte(i) else SP.id_to_piece(i).replace("▁", " ").encode() for i in b)
    return (a, b) if b"".join(VOCAB_A[i] for i in a) == raw == spelled else ([], [])


def brute(texts):
    """One row a text, from sets of ends and all token pairs."""
    docs, count = [], Counter()
    for text in texts:
        a, b = encode(text)
        size_b = [1 if SP.is_byte(i) else len(SP.id_to_piece(i).replace("▁", " ").encode()) for i in b]
        ends_a = [sum(len(VOCAB_A[i]) for i in a[:k + 1]) for k in range(len(a))]
        ends_b = [sum(size_b[:k + 1]) for k in range(len(b))]
        common = sorted(set(ends_a) & set(ends_b))
        groups, links = [], Counter()
        for low, high in zip([0, *common], common, strict=False):
            of_a = [i for i, e in zip(a, ends_a, strict=True) if low < e <= high]
            of_b = [i for i, e in zip(b, ends_b, strict=True) if low < e <= high]
            groups.append(f"{','.join(map(str, of_a))}|{','.join(map(str, of_b))}")
            links.update((i, j) for i in of_a for j in of_b)
        docs.append((len(a), len(b), len(groups), links, ";".join(groups)))
        count.update(links.keys())
    most = defaultdict(int)
    for (i, _), n in count.items():
        most[i] = max(most[i], n)
    return [(na, nb, ng, sum(links.values()), sum(n for p, n in links.items() if count[p] == most[p[0]]),
             sum(n * count[p] for p, n in links.items()), spelled) for na, nb, ng, links, spelled in docs]


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 60)), st.sets(st.integers(0, 60)))
def test_gallop(x, y):
    x, y = (np.array(sorted(v), dtype=np.int64) for v in (x, y))
    n = np.full(len(x), len(y))
    assert A.gallop(x, y, 0 * n, n).tolist() == [y.tolist().index(v) if v in y else -1 for v in x]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(1, 29)), st.sets(st.integers(1, 29))), max_size=5))
def test_common_ends(texts):
    """Texts of 30 bytes; both lists of a text end at its end."""
    ends = [np.array([30 * k + v for k, t in enumerate(texts) for v in [*sorted(t[i]), 30]], dtype=np.int64) for i in (0, 1)]
    stops = [np.cumsum([len(t[i]) + 1 for t in texts]).astype(np.int64) for i in (0, 1)]
    a, b = A.common_ends(ends[0], stops[0], ends[1], stops[1])
    want = sorted(set(ends[0].tolist()) & set(ends[1].tolist()))
    assert ends[0][a].tolist() == want == ends[1][b].tolist()


def test_wide_groups(monkeypatch):
    texts = odd_texts(150, 8) + ["the cat sat", "\U0001f642" * 200]
    want = [A.slice_of(ALIGNER, [t], False) for t in texts]
    monkeypatch.setattr(A, "WIDE", 1)
    narrow = A.Aligner()
    for t, w in zip(texts, want, strict=True):
        got = A.slice_of(narrow, [t], False)
        assert all((got[c] == w[c]).all() for c in ("counts", "pair", "n", "pairs", "times", "end"))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "a", "the", "hello", "\n", "\t", ".", ",", "é", "́", " ", "­", "͸", "中", "▁", "\U0001f642", "'s", "12",
                                 "<s>", "<|endoftext|>", "<0x0A>", "　", "\x1c", "\x00", "а"]), max_size=14).map("".join))
def test_cut_texts_align_like_whole_ones(text):
    got = A.slice_of(ALIGNER, [text], False)
    want = brute([text])[0]
    assert tuple(got["counts"][0].tolist()) == want[:4] and got["groups"] == [want[6]]


ALIGNER = A.Aligner()


def rows_of(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted([tuple(r) for r in A.align(df).collect()], key=repr)


def test_equals_brute_force(spark):
    texts = odd_texts(400, 3) + ["x" * 3000, "\U0001f642" * 300, "the cat " * 50, "the cat"]
    assert rows_of(spark, list(enumerate(texts))) == sorted([(i, *r) for i, r in enumerate(brute(texts))], key=repr)


def test_slices_of_many_sizes(spark, monkeypatch):
    texts = odd_texts(300, 4)
    small = A.Aligner(most=50)  # forgets all the time
    for at in range(0, 300, 7):
        part = texts[at:at + 7]
        got = A.slice_of(small, part, False)
        assert got["groups"] == [r[6] for r in brute(part)]


def test_edges(spark):
    df = edge_docs(spark, "slice", "ids", "pair", "count", "text2", "at", "n", "a")
    got = sorted([tuple(r) for r in A.align(df).collect()], key=repr)
    short = [(i, t if t is None or len(t) < 50_000 else "long words and more of them " * 4000) for i, t in EDGE]
    want = brute_fast(short)
    assert got == want
    assert A.align(empty_docs(spark)).count() == 0


def brute_fast(rows):
    """``brute`` with running ends, for long texts."""
    docs, count = [], Counter()
    for rid, text in rows:
        a, b = encode(text)
        ends = [[], []]
        for out, toks in ((ends[0], [len(VOCAB_A[i]) for i in a]),
                          (ends[1], [1 if SP.is_byte(i) else len(SP.id_to_piece(i).replace("▁", " ").encode()) for i in b])):
            at = 0
            for n in toks:
                at += n
                out.append(at)
        place_a, place_b = ({e: k for k, e in enumerate(x)} for x in ends)
        groups, links, i, j = [], Counter(), 0, 0
        for e in sorted(place_a.keys() & place_b.keys()):
            of_a, of_b = a[i:place_a[e] + 1], b[j:place_b[e] + 1]
            i, j = place_a[e] + 1, place_b[e] + 1
            groups.append(f"{','.join(map(str, of_a))}|{','.join(map(str, of_b))}")
            links.update((x, y) for x in of_a for y in of_b)
        docs.append((rid, len(a), len(b), len(groups), links, ";".join(groups)))
        count.update(links.keys())
    most = defaultdict(int)
    for (i, _), n in count.items():
        most[i] = max(most[i], n)
    return sorted([(rid, na, nb, ng, sum(links.values()), sum(n for p, n in links.items() if count[p] == most[p[0]]),
                    sum(n * count[p] for p, n in links.items()), s) for rid, na, nb, ng, links, s in docs], key=repr)


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    df = A.op13_alignment(spark, SF)
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = [(*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[7] else "") for r in brute_fast(rows)]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(want, key=repr)
