"""Linear-chain conditional random field over the words of texts.

Words are runs of letters. A word's score for a label is the sum of learned
weights of its features: the word, its prefixes and suffixes of 1 to 4 bytes,
its 3-byte n-grams (all hashed to a fixed table), and lexicon membership.
Neighbouring labels add learned transition weights. Marginals come from the
forward-backward recursions, run over all texts of a batch at once: the chain
of all words is cut into strips, each strip's product of transfer matrices
carries the state across it, and the recursions run through all strips side by
side. Text starts reset the state, so texts do not influence each other.
"""
from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np

from tradewind.llm.byte_spans import ByteSpans, mix

BUCKETS = 1 << 17  # rows of the hashed weight table
_MARK = re.compile(r"(?![\x00-\x7f])[\W\d]")
AFFIX = 4
GRAM = 3
STRIP = 96
SLICE = 200_000  # bytes of text whose arrays are held at once in training

#: Bytes of words: letters of ASCII, and every byte of other code points, of
#: which ``fold`` leaves only letters.
LETTER = np.zeros(256, dtype=bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def fold(text: str | None) -> str:
    """Lower case, and blanks for quotes, dashes and other marks beyond ASCII,
    kept to the same number of code points. Its words are the runs of letters by
    Unicode class, in training as in scoring."""
    text = text or ""
    if text.isascii():
        return text.lower()
    low = text.lower()
    low = low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return _MARK.sub(" ", low)


def slices(texts: list[str | None], most: int = SLICE):
    """The texts in their order, in lists of at most ``most`` bytes (a longer
    text is a list of its own)."""
    part, size = [], 0
    for t in texts:
        n = len((t or "").encode("utf-8", "surrogatepass"))
        if part and size + n > most:
            yield part
            part, size = [], 0
        part.append(t)
        size += n
    if part:
        yield part


def _bucket(h: np.ndarray, kind: int) -> np.ndarray:
    return (mix(h + np.uint64(kind * 0x632BE59BD9B4E019 % (1 << 64))) >> np.uint64(64 - 17)).astype(np.int32)


class Words:
    """The words of some texts and their features, ready for scoring."""

    def __init__(self, texts: list[str | None]):
        raw = [fold(t).encode("utf-8", "surrogatepass") for t in texts]
        self.spans = ByteSpans(b" ".join(raw) + b" ")
        self.at = np.cumsum([0] + [len(r) + 1 for r in raw])
        start, stop = self.start, self.stop = self.spans.runs(LETTER[self.spans.data])
        self.n = len(start)
        self.first = np.searchsorted(start, self.at)  # of each text, and the end
        self.resets = np.zeros(self.n, dtype=bool)
        self.resets[self.first[:-1][self.first[:-1] < self.n]] = True
        self.hash = self.spans.hash(start, stop)
        size = stop - start
        cols = [_bucket(self.hash, 0)]
        for k in range(1, AFFIX + 1):
            cut = np.minimum(size, k)
            cols.append(_bucket(self.spans.hash(start, start + cut), k))
            cols.append(_bucket(self.spans.hash(stop - cut, stop), AFFIX + k))
        self.fixed = np.stack(cols) if self.n else np.zeros((1 + 2 * AFFIX, 0), dtype=np.int32)
        grams = np.maximum(0, size - GRAM + 1)
        self.gram_end = np.cumsum(grams)
        word = np.repeat(np.arange(self.n), grams)
        p = start[word] + np.arange(len(word)) - (self.gram_end - grams)[word]
        self.grams = _bucket(self.spans.hash(p, p + GRAM), 2 * AFFIX + 1)

    def features(self) -> Words:
        """These words without their places in the text, to train on."""
        del self.spans, self.start, self.stop
        return self

    def scores(self, table: np.ndarray, lexicon: np.ndarray, lexicon_label: np.ndarray, bonus: np.ndarray) -> np.ndarray:
        out = np.zeros((self.n, table.shape[1]), dtype=np.float32)
        for row in self.fixed:
            out += table[row]
        sums = np.zeros((len(self.grams) + 1, table.shape[1]))
        np.cumsum(table[self.grams], axis=0, dtype=np.float64, out=sums[1:])
        out += (sums[self.gram_end] - sums[np.r_[0, self.gram_end[:-1]]]) if self.n else 0
        known = self.lexical(lexicon, lexicon_label)
        out += bonus[known]
        return out

    def lexical(self, lexicon, label) -> np.ndarray:
        """Label of each word in the lexicon, or the number of labels."""
        none = len(label) and int(label[-1])
        if len(lexicon) <= 1:
            return np.full(self.n, none)
        at = np.minimum(np.searchsorted(lexicon[:-1], self.hash), len(lexicon) - 2)
        return np.where(lexicon[at] == self.hash, label[at], none)


def marginals(scores: np.ndarray, resets: np.ndarray, move: np.ndarray, begin: np.ndarray,
              pairs: bool = False):
    """P(label of word | its text), shape (words, labels); with ``pairs`` also
    the expected transitions and begins. ``move`` and ``begin`` are log weights."""
    n, k = scores.shape
    if not n:
        return (np.zeros((0, k)), np.zeros((k, k)), np.zeros(k)) if pairs else np.zeros((0, k))
    strips = -(-n // STRIP)
    x = np.ones((strips * STRIP, k))
    x[:n] = np.exp(scores - scores.max(axis=1, keepdims=True))
    x = x.reshape(strips, STRIP, k).transpose(1, 0, 2).copy()
    reset = np.ones(strips * STRIP, dtype=bool)  # the padding is texts of its own
    reset[:n] = resets
    reset = reset.reshape(strips, STRIP).T[:, :, None]
    a, start = np.exp(move), np.exp(begin)

    # Across strips: product of the strip's transfer matrices.
    prod = np.broadcast_to(np.eye(k), (strips, k, k)).copy()
    for t in range(STRIP):
        step = np.where(reset[t][:, :, None], prod.sum(axis=2, keepdims=True) * start, prod @ a)
        prod = step * x[t][:, None, :]
        prod /= prod.sum(axis=(1, 2), keepdims=True)
    into, out_of = np.empty((strips, k)), np.empty((strips, k))
    state = np.ones(k) / k
    for s in range(strips):
        into[s] = state
        state = state @ prod[s]
        state /= state.sum()
    state = np.ones(k)
    for s in range(strips - 1, -1, -1):
        out_of[s] = state
        state = prod[s] @ state
        state /= state.sum()

    # Inside strips, side by side.
    forward, before, back = np.empty_like(x), np.empty_like(x), np.empty_like(x)
    state = into
    for t in range(STRIP):
        before[t] = state
        state = np.where(reset[t], state.sum(axis=1, keepdims=True) * start, state @ a) * x[t]
        state /= state.sum(axis=1, keepdims=True)
        forward[t] = state
    state = out_of
    for t in range(STRIP - 1, -1, -1):
        back[t] = state
        seen = state * x[t]
        state = np.where(reset[t], seen @ start[:, None] * np.ones(k), seen @ a.T)
        state /= state.sum(axis=1, keepdims=True)
    both = forward * back
    both /= both.sum(axis=2, keepdims=True)
    flat = both.transpose(1, 0, 2).reshape(-1, k)[:n]
    if not pairs:
        return flat
    left = before.transpose(1, 0, 2).reshape(-1, k)[:n][~resets]
    right = (back * x).transpose(1, 0, 2).reshape(-1, k)[:n][~resets]
    norm = ((left @ a) * right).sum(axis=1, keepdims=True)
    return flat, a * ((left / norm).T @ right), flat[resets].sum(axis=0)


@dataclass
class Model:
    labels: list
    table: np.ndarray
    move: np.ndarray
    begin: np.ndarray
    lexicon: np.ndarray       # sorted word hashes, then a closing entry
    lexicon_label: np.ndarray  # label index of each; the closing one is "none"
    bonus: np.ndarray         # weights of lexicon membership; last row zero

    def marginals(self, words: Words) -> np.ndarray:
        return marginals(words.scores(self.table, self.lexicon, self.lexicon_label, self.bonus), words.resets, self.move, self.begin)


def fit(words: Words | list[Words], gold: np.ndarray, labels: list, rounds: int = 30, rate: float = 0.3,
        weight: np.ndarray | None = None, l2: float = 1e-4) -> Model:
    """Maximum likelihood of the words' gold labels, by full-batch Adagrad.
    The lexicon holds the words seen 3 times or more, 95 in 100 with one label.
    Words in several parts are labelled part by part, and each round adds up
    their gradients."""
    parts = [words] if isinstance(words, Words) else words
    k, n = len(labels), sum(p.n for p in parts)
    w = np.ones(n) if weight is None else weight
    resets = np.concatenate([p.resets for p in parts])
    unique, inverse = np.unique(np.concatenate([p.hash for p in parts]), return_inverse=True)
    by = np.zeros((len(unique), k))
    np.add.at(by, (inverse, gold), 1)
    sure = (by.max(axis=1) >= 0.95 * by.sum(axis=1)) & (by.sum(axis=1) >= 3) if len(unique) else np.zeros(0, dtype=bool)
    lexicon = np.r_[unique[sure], np.uint64(0)].astype(np.uint64)
    lexicon_label = np.r_[by[sure].argmax(axis=1) if sure.any() else np.zeros(0, dtype=np.int64), k].astype(np.int64)
    m = Model(labels, np.zeros((BUCKETS, k), dtype=np.float32), np.zeros((k, k)), np.zeros(k), lexicon, lexicon_label, np.zeros((k + 1, k)))
    follow = ~resets[1:] if n else np.zeros(0, dtype=bool)
    true_move = np.zeros((k, k))
    if n:
        np.add.at(true_move, (gold[:-1][follow], gold[1:][follow]), 1)
    true_begin = np.bincount(gold[resets], minlength=k).astype(float) if n else np.zeros(k)
    memory = [np.full(p.shape, 1e-2) for p in (m.table, m.move, m.begin, m.bonus)]
    for _ in range(rounds if n else 0):
        table, bonus, moves, begins, at = np.zeros((k, BUCKETS)), np.zeros((k, k + 1)), np.zeros((k, k)), np.zeros(k), 0
        for part in parts:
            of = slice(at, at + part.n)
            at += part.n
            got, move, begin = marginals(part.scores(m.table, m.lexicon, m.lexicon_label, m.bonus), part.resets, m.move, m.begin, pairs=True)
            moves += move
            begins += begin
            gap = (np.eye(k)[gold[of]] - got) * w[of, None] / n
            index, grams = np.r_[part.fixed.ravel(), part.grams], np.diff(part.gram_end, prepend=0)
            known = part.lexical(lexicon, lexicon_label)
            for j, g in enumerate(gap.T):
                table[j] += np.bincount(index, weights=np.r_[np.tile(g, len(part.fixed)), np.repeat(g, grams)], minlength=BUCKETS)
                bonus[j] += np.bincount(known, weights=g, minlength=k + 1)
        bonus[:, k] = 0
        grads = [table.T, (true_move - moves) / n, (true_begin - begins) / n, bonus.T]
        for p, g, s in zip((m.table, m.move, m.begin, m.bonus), grads, memory, strict=True):
            g = g * 1000 - l2 * p
            s += g * g
            p += (rate * g / np.sqrt(s)).astype(p.dtype)
    return m
