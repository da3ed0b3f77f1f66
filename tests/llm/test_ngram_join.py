import random

import numpy as np

from tests.llm.helpers import EDGE, SF, docs_of, edge_docs, empty_docs
from tradewind.llm import ngram_join as J


def brute_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 4]) for i in range(max(1, len(words) - 3))} if words else set()


def brute_components(rows):
    """(id, text) -> {row number: component id}; ids not null."""
    sets = [brute_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                root[find(i)] = find(j)
    names = {}
    for i, (rid, _) in enumerate(rows):
        if sets[i]:
            names[find(i)] = min(rid, names.get(find(i), rid))
    return [(rid, len(sets[i]), names[find(i)] if sets[i] else rid) for i, (rid, _) in enumerate(rows)]


def result(df):
    return sorted((r.id, r.n_shingles, r.component_id) for r in df.collect())


def test_shingle_sets_match_brute_force():
    texts = ["A b c D e", "a B\tc\nd  e", "one two", "", None, "É b c d", "x y z w x y z w x y z w", "a\x0bb\x0cc d e\x85f"]
    got = J.shingle_sets(texts)
    assert [len(s) for s in got] == [len(brute_set(t)) for t in texts]
    assert np.array_equal(got[0], got[1])


def test_query(spark):
    got = sorted(tuple(r) for r in J.op3_ngram_jaccard(spark, SF).collect())
    assert got == sorted(brute_components(sorted(docs_of(spark).items())))


def test_dense_group_and_chains(spark):
    """A group of near copies larger than a hot bucket, at edit distances on
    both sides of the threshold, beside unrelated texts and exact copies."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randrange(0, 6)):
            words[rng.randrange(120)] = f"e{rng.randrange(10**6)}"
        rows.append((1000 - i, " ".join(words)))
    rows += [(2000 + i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(50))) for i in range(60)]
    rows += [(3000 + i, rows[i % 7][1].upper()) for i in range(40)]
    chain = [f"c{i}" for i in range(200)]
    rows += [(4000 + i, " ".join(chain[3 * i:3 * i + 100])) for i in range(30)]  # neighbours linked, ends not
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(J.jaccard_components(df)) == sorted(brute_components(rows))


def test_edge_rows(spark):
    out = J.jaccard_components(edge_docs(spark, "jid", "n", "comp", "component_id", "slice"))
    got = {}
    for r in out.collect():
        got.setdefault(r.id, []).append((r.n_shingles, r.component_id))
    assert sum(map(len, got.values())) == len(EDGE)
    assert got[1] == [(6, 1)] * 2 and sorted(got[5]) == [(1, 5), (6, 1)]
    assert got[2] == [(0, 2)] and got[3] == [(0, 3)] and got[4] == [(0, 4)]
    assert sorted(got[None]) == [(0, None), (2, None)]
    assert got[9] == [(1, 9)]
    assert J.jaccard_components(empty_docs(spark)).count() == 0
    all_null = spark.createDataFrame([(1, None), (2, None)], "doc_id long, text string")
    assert result(J.jaccard_components(all_null)) == [(1, 0, 1), (2, 0, 2)]


def test_prefix_length_keeps_every_link():
    for n in range(1, 200):
        least = -(-85 * n // 100)
        assert J.prefix_length(n) == n - least + 1


def test_components_of_a_graph(spark):
    from tradewind.llm.graph import components
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)] + [(5, 5)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert got == {n: find(n) for n in root}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
