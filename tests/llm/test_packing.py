import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.helpers import EDGE, SF, docs_of, edge_docs, empty_docs
from tests.llm.test_bpe import odd_texts
from tradewind.llm import packing as K

TOK = Tokenizer.from_file(K.TOKENIZER)


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 200), max_size=20))
def test_plan_holds_every_item_once(histogram):
    left, load = {k: set() for k in histogram}, defaultdict(int)
    for size, lo, hi, sequence, each, slot in K.plan(histogram, 32):
        assert (hi - lo) % each == 0 and slot >= 0
        assert not left[size] & set(range(lo, hi))
        left[size] |= set(range(lo, hi))
        for r in range(lo, hi):
            load[sequence + (r - lo) // each] += size
    assert {k: sorted(v) for k, v in left.items()} == {k: list(range(n)) for k, n in histogram.items()}
    assert all(x <= 32 for x in load.values()) and sorted(load) == list(range(len(load)))
    assert len(load) <= 2 * sum(k * n for k, n in histogram.items()) / 32 + 2


def test_column_generation_beats_one_size_patterns():
    sizes, counts = np.array([3, 5, 7]), np.array([40.0, 40.0, 40.0])
    patterns, x = K.column_generation(sizes, counts, 10)
    assert np.allclose(x @ patterns, counts) and (patterns @ sizes <= 10).all()
    # 7 with 3, two 5s: 40 + 20 sequences, all full.
    assert x.sum() <= 60.2


def test_ids_as_the_library():
    texts = odd_texts(1500, 9)
    want = [TOK.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in K._encoder(K.TOKENIZER)(texts)] == want


def check(rows, texts, max_len=1024):
    """rows: (id, start, length, crc, tokens, sequence, offset); ``texts``: all
    documents' texts, as (id, text)."""
    whole = defaultdict(list)
    for rid, text in texts:
        ids = [*TOK.encode(text, add_special_tokens=False).ids, 0]
        for at in range(0, len(ids), max_len):
            part = np.array(ids[at:at + max_len], dtype="<u4")
            whole[(rid, at, len(part), zlib.crc32(part.tobytes()), len(ids))].append(1)
    got, load = defaultdict(list), defaultdict(list)
    for r in rows:
        got[tuple(r[:5])].append(1)
        load[r[5]].append((r[6], r[2]))
    assert got == whole
    for pieces in load.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= max_len
    return 1 - sum(r[2] for r in rows) / (max_len * max(1, len(load)))


def test_query(spark):
    waste = check([tuple(r) for r in K.op9_packing(spark, SF).collect()], docs_of(spark).items())
    assert waste < 0.02


def test_edge_rows(spark):
    cols = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    out = K.pack_documents(edge_docs(spark, "class", "part", "idx", "length", "slot"), max_len=64, keep_ids=True)
    assert "ids" in out.columns
    check([tuple(r) for r in out.select(*cols).collect()], [(i, t or "") for i, t in EDGE], 64)
    assert K.pack_documents(empty_docs(spark)).count() == 0


def test_equal_short_documents_fill_their_sequences(spark):
    for text, tokens in (("", 1), ("a b c d", 5)):
        rows = K.pack_documents(spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))).collect()
        assert {r.doc_tokens for r in rows} == {tokens} and len(rows) == 20_000
        assert 20_000 * tokens >= 0.98 * 1024 * max(r.sequence_id for r in rows)  # the last one is what is left


def test_further_columns_keep_their_names(spark):
    names = ["size", "rank", "lo", "hi", "slot", "sequence", "before", "each", "first", "piece"]
    pieces = K.materialize(K.token_pieces(spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")), "pieces")
    out = K.pack_pieces(K.materialize(pieces.withColumns({n: F.lit(n) for n in names}), "pieces"))
    assert all(r[n] == n for r in out.collect() for n in names) and out.count() == 2
