import base64
import hashlib
import random

import numpy as np
import tiktoken

from tests.llm.helpers import EDGE, SF, docs_of, edge_docs, empty_docs
from tradewind.llm import bpe as B
from tradewind.llm.chunks import Chunks, cut

with open(B.RANKS, "rb") as f:
    TIKTOKEN = tiktoken.Encoding("own", pat_str=B.PATTERN, special_tokens={},
                                 mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})

#: Contractions, runs of white space, marks beside words, control and rare code points.
ALPHABET = " \n\t\r'sdtlm.,!_aAé中文԰ՙ\u3000\x1c\x85\xa0\U0001f642٣१ñ09\x00\ua7cf\U00010940"


def odd_texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(n)] + \
        ["", "a" * 3000, "ab" * 300, "   \n\n  x", "<|endoftext|>", "word , next. Then... end.", "x_, y_. z.", ". a", "a ."]


def test_encoding_and_decoding_as_the_library(spark):
    b, texts = B.Bpe(), odd_texts(2000)
    got = b.encode(texts)
    assert [x.tolist() for x in got] == [TIKTOKEN.encode_ordinary(t) for t in texts]
    assert b.known.decoded() == [t.encode() for t in texts] == b.decode(got)


def test_long_words_by_either_query():
    b, rng = B.Bpe(), random.Random(1)
    for n in (1, 30, 64, 65, 300):
        words = ["".join(rng.choice("abetinsr") for _ in range(n)) for _ in range(12)] + ["a" * n, "the" * n]
        raw = [w.encode() for w in words]
        want = [TIKTOKEN._encode_single_piece(r) for r in raw]
        assert [x.tolist() for x in b._run(B.ENCODE_LONG, raw, raw)] == want
        assert [x.tolist() for x in b.encode_words(words)] == want
    assert b.encode_words(["a" * 50_000])[0].tolist() == TIKTOKEN._encode_single_piece(b"a" * 50_000)


def test_chunk_table_starts_anew():
    seen = []

    def encode(chunks):
        seen.extend(chunks)
        return [np.array([len(c)], dtype=np.int32) for c in chunks]
    c = Chunks(encode, most=3)
    for _ in range(3):
        assert [x.tolist() for x in c.ids([["aa", "b", "aa"], [], ["", "ccc"]])] == [[2, 1, 2], [], [3]]
    assert seen.count("aa") == 3 and len(c.index) <= 4
    assert "".join(cut("a b. c\nd")) == "a b. c\nd"


def test_query(spark):
    docs = docs_of(spark)
    for r in B.op8_byte_bpe(spark, SF).collect():
        ids, raw = TIKTOKEN.encode_ordinary(docs[r.doc_id]), docs.pop(r.doc_id).encode()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(raw).hexdigest())
    assert not docs


def test_edge_rows(spark):
    rows = B.encode_decode(edge_docs(spark, "ids", "decoded")).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = [(i, TIKTOKEN.encode_ordinary(t or ""), (t or "").encode()) for i, t in EDGE]
    assert sorted(((r.id, r.ids, bytes(r.decoded)) for r in rows), key=key) == sorted(want, key=key)
    assert B.encode_decode(empty_docs(spark)).count() == 0


def test_long_random_words_are_quick():
    import time
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=20_000)), "".join(rng.choices("ACGT", k=3000)),
             "".join(rng.choices("0123456789abcdef", k=5000)), "-" * 200, "é" * 500, "\U0001f642" * 300]
    bpe = B.Bpe()
    enc = tiktoken.Encoding("own", pat_str=B.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    start = time.time()
    got = bpe.encode(words[:1])
    assert time.time() - start < 10 and got[0].tolist() == enc.encode_ordinary(words[0])
    assert [x.tolist() for x in bpe.encode(words)] == [enc.encode_ordinary(w) for w in words]
