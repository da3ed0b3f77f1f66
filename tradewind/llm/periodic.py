"""Periodic runs of words, by internal pattern matching.

A run is a stretch of consecutive words with smallest period q, at least
``EXPONENT`` periods and ``SHORTEST`` words long, that neither neighbour extends.
Words are numbered within their document, the documents of a slice are strung
together with a separator of its own behind each, and doubling sorts all
suffixes, keeping the ranks of every dyadic length. A block of 2^k words at a
multiple of 2^k is then an interval of the suffix array, and a wavelet tree over
the array gives the block's next occurrences behind it (range successor). The
windows of the levels together cover every period once; every run holds a block
with its copy one period on. One or two occurrences in a window are candidate
periods; three or more form a progression, whose difference is the block's own
period: then only the shifts that align the ends of the two stretches with that
period can be periods of a longer run. Candidates are extended both ways through
the dyadic ranks.
"""
from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import carried, read, text_batches

EXPONENT = 4
SHORTEST = 6
SLICE = 1_000_000  # bytes of text strung together


class DyadicRanks:
    """``ranks[k][i]``: place in the suffix array of the first suffix that begins
    with the 2^k symbols at i. ``blocks[k]``: the multiples of 2^k whose 2^k
    symbols stand elsewhere too, and the sizes of their intervals."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        count = np.bincount(symbols)
        rank = (np.cumsum(count) - count)[symbols].astype(np.int32)
        self.ranks, self.blocks = [rank], []
        live = np.flatnonzero(count[symbols] > 1)  # in an interval of two or more
        size = count[symbols[live]]
        while True:
            width = 1 << len(self.blocks)
            at = live % width == 0
            self.blocks.append((live[at], size[at]))
            if not len(live):
                break
            # No separator stands within ``width`` of a live suffix, so there is
            # a symbol right behind.
            old = rank[live].astype(np.int64)
            key = old * n + rank[live + width]
            order = np.argsort(key, kind="stable")
            live, key, old = live[order], key[order], old[order]
            place = np.arange(len(live))
            new = np.r_[True, key[1:] != key[:-1]]
            first = np.maximum.accumulate(np.where(new, place, 0))
            group = np.maximum.accumulate(np.where(np.r_[True, old[1:] != old[:-1]], place, 0))
            rank = rank.copy()
            rank[live] = old + first - group
            self.ranks.append(rank)
            starts = np.flatnonzero(new)
            size = np.repeat(np.diff(np.r_[starts, len(live)]), np.diff(np.r_[starts, len(live)]))
            live, size = live[size > 1], size[size > 1]
        self.suffixes = np.empty(n, dtype=np.int32)
        self.suffixes[rank] = np.arange(n, dtype=np.int32)

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Symbols that the suffixes at i and j (other places) have in common."""
        got = np.zeros(len(i), dtype=np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            got += (self.ranks[k][i + got] == self.ranks[k][j + got]).astype(np.int64) << k
        return got

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Symbols that stand alike right before i and j, i < j."""
        got = np.zeros(len(i), dtype=np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            a, b = i - got - (1 << k), j - got - (1 << k)
            same = (a >= 0) & (self.ranks[k][np.maximum(a, 0)] == self.ranks[k][np.maximum(b, 0)])
            got += same.astype(np.int64) << k
        return got


class WaveletTree:
    """Order statistics of any interval of an array; the tree's levels lie side
    by side (zeros before ones), each as the number of zeros before a place."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.zeros = []
        for b in range(self.bits - 1, -1, -1):
            zero = (values >> b) & 1 == 0
            self.zeros.append(np.concatenate([np.zeros(1, dtype=np.int32), np.cumsum(zero, dtype=np.int32)]))
            values = np.concatenate([values[zero], values[~zero]])

    def below(self, left, right, bound) -> np.ndarray:
        """How many values in [left, right) are less than ``bound``."""
        out, size = np.zeros(len(left), dtype=np.int64), right - left
        for b, zeros in zip(range(self.bits - 1, -1, -1), self.zeros, strict=True):
            l0, r0 = zeros[left], zeros[right]
            one = (bound >> b) & 1 == 1
            out += np.where(one, r0 - l0, 0)
            left = np.where(one, zeros[-1] + left - l0, l0)
            right = np.where(one, zeros[-1] + right - r0, r0)
        return np.where(bound >> self.bits > 0, size, out)

    def smallest(self, left, right, nth) -> np.ndarray:
        """The nth value (from 0) of [left, right) in ascending order."""
        out = np.zeros(len(left), dtype=np.int64)
        nth = nth.copy()
        for b, zeros in zip(range(self.bits - 1, -1, -1), self.zeros, strict=True):
            l0, r0 = zeros[left], zeros[right]
            one = nth >= r0 - l0
            nth -= np.where(one, r0 - l0, 0)
            out |= one.astype(np.int64) << b
            left = np.where(one, zeros[-1] + left - l0, l0)
            right = np.where(one, zeros[-1] + right - r0, r0)
        return out

    def successors(self, left, right, low, high, most: int) -> list[np.ndarray]:
        """The ``most`` smallest values in [low, high] of each interval, -1
        where there are fewer."""
        out = []
        nth = self.below(left, right, low)
        open_ = np.flatnonzero(nth < right - left)
        for _ in range(most):
            found = np.full(len(left), -1, dtype=np.int64)
            if len(open_):
                got = self.smallest(left[open_], right[open_], nth[open_])
                inside = got <= high[open_]
                found[open_[inside]] = got[inside]
                nth[open_] += 1
                open_ = open_[inside & (nth[open_] < (right - left)[open_])]
            out.append(found)
        return out


def find_runs(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and smallest periods of all runs, by start, then period.
    ``symbols`` are small non-negative integers; the last one, and the one behind
    each document, stands nowhere else."""
    none = np.zeros(0, dtype=np.int64)
    if len(symbols) < 2:
        return none, none, none
    d = DyadicRanks(symbols)
    tree = None
    found = []
    for k in range(1, len(d.blocks)):
        block, size = d.blocks[k]
        if not len(block):
            continue
        tree = tree or WaveletTree(d.suffixes)
        width = 1 << k
        # Periods from 2/3 of the block to under 4/3; the first level takes 1 too.
        low = block + (-(-2 * width // 3) if k > 1 else 1)
        high = block + (4 * width - 1) // 3
        left = d.ranks[k][block].astype(np.int64)
        one, two, three = tree.successors(left, left + size, low, high, 3)
        few = three < 0
        for other in (one, two):
            at = few & (other >= 0)
            found.append((block[at], other[at] - block[at]))
        if not few.all():
            at, to = block[~few], one[~few]
            step = two[~few] - to
            ends = to + d.ahead(to, to + step) - at - d.ahead(at, at + step)
            starts = to - d.behind(to, to + step) - at + d.behind(at, at + step)
            found += [(at, ends), (at, starts)]
    if not found:
        return none, none, none
    at, period = (np.concatenate(c) for c in zip(*found, strict=True))
    at, period = at[period > 0], period[period > 0]
    start = at - d.behind(at, at + period)
    length = at + period + d.ahead(at, at + period) - start
    long = length >= np.maximum(SHORTEST, EXPONENT * period)
    start, length, period = start[long], length[long], period[long]
    order = np.lexsort((period, length, start))  # one stretch: its smallest period first
    start, length, period = start[order], length[order], period[order]
    new = np.r_[True, (start[1:] != start[:-1]) | (length[1:] != length[:-1])][:len(start)]
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def document_runs(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of each list of words: document, start, length, period."""
    parts, base = [], 0
    for words in texts:
        index = dict(zip(dict.fromkeys(words), range(len(words)), strict=False))
        own = np.fromiter(map(index.__getitem__, words), dtype=np.int32, count=len(words))
        parts += [own + base, np.array([base + len(index)], dtype=np.int32)]
        base += len(index) + 1
    symbols = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32)
    at = np.cumsum([0] + [len(w) + 1 for w in texts])
    start, length, period = find_runs(symbols)
    doc = np.searchsorted(at, start, "right") - 1
    return doc, start - at[doc], length, period


def collapsed(words: list[bytes], runs) -> bytes:
    """The words without those that a run holds behind its first period."""
    drop = np.zeros(len(words), dtype=bool)
    for start, length, period in runs:
        drop[start + period:start + length] = True
    return b" ".join([words[i] for i in np.flatnonzero(~drop).tolist()])


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, reorder=None) -> DataFrame:
    """``id``, ``n_words`` long, ``runs`` (array of start, length, period, all
    long, by start, then period) and ``collapsed`` (binary, UTF-8: the words that
    stay, joined by one space). Words are runs of bytes other than ASCII white
    space. ``reorder(id, n)`` may return word numbers that stand in for the
    text's n words before anything else.

    A null, empty or blank text has no words, no runs and an empty ``collapsed``. Repeated
    rows and null ids are answered like any others; an empty table gives an
    empty result. Columns in ``carry`` follow under their own names. No row
    needs another, so nothing is shuffled; the memory of a task grows with its
    longest text (some 20 bytes a word and doubling)."""
    rows, source, schema, named = carried(df, id_col, text_col, carry or [])
    rows = rows.withColumn("raw", F.col("text").cast("binary"))
    if "text" not in source:
        rows = rows.drop("text")
    keep = [f"k{i}" for i in range(len(named))]

    def run(batches):
        import pyarrow as pa
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for whole in batches:
            for b in text_batches(whole, ["raw"], SLICE):
                texts = []
                for rid, raw in zip(b.column("id").to_pylist(), b.column("raw").to_pylist(), strict=True):
                    words = raw.split() if raw else []
                    order = reorder(rid, len(words)) if reorder else None
                    texts.append(words if order is None else [words[i] for i in order.tolist()])
                of: list = [[] for _ in texts]
                for doc, *one in zip(*[c.tolist() for c in document_runs(texts)], strict=True):
                    of[doc].append(one)
                short = [collapsed(w, r) if r else b" ".join(w) for w, r in zip(texts, of, strict=True)]
                runs = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in of]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.array([len(w) for w in texts], pa.int64()), pa.array(runs, kind), pa.array(short, pa.binary()),
                     *[b.column(c) for c in source]], names=["id", "n_words", "runs", "collapsed", *keep])

    return rows.mapInArrow(run, "id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed binary" + schema).select(
        "id", "n_words", "runs", "collapsed", *named)


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """The order of words that op11 plants in a tenth of the documents."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Runs of all documents, the planted ones included."""
    found = periodic_runs(read(spark, sf_dir, "documents"), reorder=planted)
    best = F.aggregate("runs", F.lit(None).cast("struct<start:long,length:long,period:long>"),
                       lambda top, r: F.when(top.isNull() | (r["length"] * top["period"] > top["length"] * r["period"]), r).otherwise(top))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.withColumn("best", best).select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.expr("1000 * best.length div best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
