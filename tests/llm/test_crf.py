import itertools

import numpy as np
import pytest

from tradewind.llm import crf


@pytest.mark.parametrize(("n", "k"), [(1, 2), (5, 3), (7, 2)])
def test_marginals_match_enumeration(n, k):
    rng = np.random.default_rng(n)
    scores, move, begin = rng.normal(size=(n, k)), rng.normal(size=(k, k)), rng.normal(size=k)
    resets = np.zeros(n, dtype=bool)
    resets[[0, n // 2]] = True
    p, moves, begins, z = np.zeros((n, k)), np.zeros((k, k)), np.zeros(k), 0.0
    for y in itertools.product(range(k), repeat=n):
        w = np.exp(sum(scores[i, y[i]] + (begin[y[i]] if resets[i] else move[y[i - 1], y[i]]) for i in range(n)))
        z += w
        for i in range(n):
            p[i, y[i]] += w
            if resets[i]:
                begins[y[i]] += w
            else:
                moves[y[i - 1], y[i]] += w
    got = crf.marginals(scores, resets, move, begin, pairs=True)
    assert all(np.allclose(a, b / z) for a, b in zip(got, (p, moves, begins), strict=True))


def test_strips_equal_one_long_chain():
    rng = np.random.default_rng(0)
    n, k = 5 * crf.STRIP + 17, 3
    scores, move, begin = rng.normal(size=(n, k)), rng.normal(size=(k, k)), rng.normal(size=k)
    resets = rng.random(n) < 0.02
    resets[0] = True
    forward, back = np.zeros((n, k)), np.ones((n, k))
    x, a, s = np.exp(scores), np.exp(move), np.exp(begin)
    for t in range(n):
        forward[t] = (s if resets[t] else forward[t - 1] @ a) * x[t]
        forward[t] /= forward[t].sum()
    for t in range(n - 2, -1, -1):
        back[t] = 1.0 if resets[t + 1] else a @ (x[t + 1] * back[t + 1])
        back[t] /= back[t].sum()
    want = forward * back
    assert np.allclose(crf.marginals(scores, resets, move, begin), want / want.sum(axis=1, keepdims=True))


def test_texts_do_not_influence_each_other():
    texts = ["alpha beta", "", None, "12 !", "Gamma delta epsilon " * 200, "ü ß"]
    rng = np.random.default_rng(1)
    m = crf.Model(["a", "b"], rng.normal(size=(crf.BUCKETS, 2)).astype(np.float32), rng.normal(size=(2, 2)), rng.normal(size=2),
                  np.zeros(1, dtype=np.uint64), np.array([2]), np.zeros((3, 2)))
    both = crf.Words(texts)
    p = m.marginals(both)
    assert np.diff(both.first).tolist() == [2, 0, 0, 0, 600, 2]
    for i, t in enumerate(texts):
        assert np.allclose(p[both.first[i]:both.first[i + 1]], m.marginals(crf.Words([t])), atol=1e-5)


def test_fit_learns_words_and_transitions():
    rng = np.random.default_rng(3)
    words = [["red", "green", "blue"], ["one", "two", "three"]]
    texts, gold = [], []
    for _ in range(80):
        state, ws = int(rng.integers(2)), []
        for _ in range(12):
            state = state if rng.random() < 0.9 else 1 - state
            ws.append("xx" if rng.random() < 0.3 else str(rng.choice(words[state])))
            gold.append(state)
        texts.append(" ".join(ws))
    m = crf.fit(crf.Words(texts), np.array(gold), ["colour", "number"])
    p = m.marginals(crf.Words(["red xx xx blue", "one xx two"]))
    assert p.argmax(axis=1).tolist() == [0, 0, 0, 0, 1, 1, 1]
    assert m.move[0, 0] > m.move[0, 1] and m.move[1, 1] > m.move[1, 0]


def test_training_in_parts_equals_training_at_once():
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(["red", "green", "one", "two", "tree", "gr\u00fcn"], size=int(rng.integers(0, 30)))) for _ in range(200)]
    parts = [crf.Words(t).features() for t in crf.slices(texts, 700)]
    whole = crf.Words(texts)
    assert [t for part in crf.slices(texts, 700) for t in part] == texts and len(parts) > 10
    assert all(sum(len(t.encode()) for t in part) <= 700 for part in crf.slices(texts, 700))
    assert [t for part in crf.slices([None, "abc", "", "d" * 9], 5) for t in part] == [None, "abc", "", "d" * 9]
    gold = rng.integers(0, 3, size=whole.n)
    a, b = (crf.fit(w, gold, ["x", "y", "z"]) for w in (parts, whole))
    assert np.array_equal(a.lexicon, b.lexicon) and np.array_equal(a.lexicon_label, b.lexicon_label)
    assert all(np.allclose(x, y, atol=1e-5) for x, y in ((a.table, b.table), (a.move, b.move), (a.begin, b.begin), (a.bonus, b.bonus)))


def test_long_tables_of_powers_are_not_kept():
    from tradewind.llm import byte_spans
    data = bytes(range(256)) * 2100  # longer than the kept tables
    long, short = byte_spans.ByteSpans(data), byte_spans.ByteSpans(data[512:768])
    assert all(len(t) <= byte_spans.KEPT for t in byte_spans._tables)
    at = np.array([0, 256, 512, len(data) - 256])
    assert long.hash(at, at + 256).tolist() == [int(short.hash(np.array([0]), np.array([256]))[0])] * 4
