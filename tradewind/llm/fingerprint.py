"""Document fingerprints from prefix polynomial hashes.

``PrefixHash`` keeps, for one text, modular prefix sums of code point times a
power of a base, for two bases modulo 2^31 - 1. The hash of any span is a
difference of two prefix values, so two spans compare in constant time and the
longest common extension is found by binary search.

A document's fingerprint is its length, its whole hash, and the hashes of its
prefixes and suffixes at a fixed ladder of lengths. Two fingerprints compare
like two texts: a binary search over the ladders gives (to a rung) the longest
common prefix and suffix, and likeness is their share of the longer text.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import read, shuffle_partitions

P = (1 << 31) - 1
BASES = (1_268_400_107, 742_938_285)


def _mod(x):
    """x mod 2^31 - 1 for 0 <= x < 2^62, by folding the high bits."""
    x = (x & P) + (x >> 31)
    return np.where(x >= P, x - P, x)


class _Powers:
    """Powers of a base and of its inverse, grown by doubling."""

    def __init__(self, base: int):
        self.steps = (base, pow(base, -1, P))
        self.tables = [np.ones(1, dtype=np.int64) for _ in self.steps]

    def upto(self, n: int):
        while len(self.tables[0]) <= n:
            m = len(self.tables[0])
            self.tables = [np.concatenate([t, _mod(t * pow(s, m, P))]) for t, s in zip(self.tables, self.steps, strict=True)]
        return self.tables


_POWERS = [_Powers(b) for b in BASES]


class PrefixHash:
    def __init__(self, text: str):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64) + 1
        self.n = len(points)
        self.pre = []
        for powers in _POWERS:
            power = powers.upto(self.n)[0]
            sums = np.zeros(self.n + 1, dtype=np.int64)
            np.cumsum(_mod(points * power[:self.n]), out=sums[1:])
            self.pre.append(_mod(sums))

    def spans(self, start, stop):
        """Hashes (64-bit) of the spans [start, stop), arrays allowed."""
        start, stop = np.asarray(start), np.asarray(stop)
        return _join([_mod(_mod(p[stop] - p[start] + P) * w.upto(self.n)[1][start]) for p, w in zip(self.pre, _POWERS, strict=True)])

    def equal(self, a: int, other: PrefixHash, b: int, length: int) -> bool:
        """Whether the spans of ``length`` at a here and at b there are equal."""
        return bool(self.spans(a, a + length) == other.spans(b, b + length))

    def common_extension(self, a: int, other: PrefixHash, b: int) -> int:
        """Length of the longest common run from a here and b there."""
        lo, hi = 0, min(self.n - a, other.n - b)
        while lo < hi:
            mid = (lo + hi + 1) // 2
            lo, hi = (mid, hi) if self.equal(a, other, b, mid) else (lo, mid - 1)
        return lo


class Spliced:
    """Prefix hashes of ``left[:k] + right[:m]``, from the two texts' arrays
    alone: no character is hashed again."""

    def __init__(self, left: PrefixHash, k: int, right: PrefixHash, m: int):
        self.n, self.k = k + m, k
        self.pre = []
        for a, b, w in zip(left.pre, right.pre, _POWERS, strict=True):
            power = int(w.upto(k)[0][k])
            self.pre.append(np.concatenate([a[:k + 1], _mod(a[k] + _mod(b[1:m + 1] * power))]))

    spans = PrefixHash.spans


def _join(parts):
    return (parts[0].astype(np.uint64) << np.uint64(31)) | parts[1].astype(np.uint64)


def rungs(n: int) -> list[int]:
    """Ladder lengths up to n: 1 to 8, then each a quarter longer."""
    out, r = [], 1
    while r <= n:
        out.append(r)
        r += max(1, r // 4) if r >= 8 else 1
    return out


def fingerprint(h) -> str:
    """``length.whole.prefix rungs.suffix rungs`` in hex, 8 digits a rung."""
    at = np.array(rungs(h.n), dtype=np.int64)
    zero = np.zeros(len(at), dtype=np.int64)
    short = [(x ^ (x >> np.uint64(30))).astype(">u4").tobytes().hex() for x in (h.spans(zero, at), h.spans(h.n - at, zero + h.n))]
    return f"{h.n:x}.{int(h.spans(0, h.n)):016x}.{short[0]}.{short[1]}"


def likeness(a: str, b: str) -> float:
    """0 to 1: 1 only for equal fingerprints; else common prefix plus common
    suffix (to a rung of the ladder) over the longer length."""
    if a == b:
        return 1.0
    (na, _, pa, sa), (nb, _, pb, sb) = a.split("."), b.split(".")
    na, nb = int(na, 16), int(nb, 16)
    steps = rungs(min(na, nb))

    def common(x, y):
        lo, hi = 0, len(steps)
        while lo < hi:
            mid = (lo + hi + 1) // 2
            lo, hi = (mid, hi) if x[8 * mid - 8:8 * mid] == y[8 * mid - 8:8 * mid] else (lo, mid - 1)
        return steps[lo - 1] if lo else 0

    longest = max(na, nb)
    return min((common(pa, pb) + common(sa, sb)) / longest, longest / (longest + 1))


def edit_pairs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row with its successor's text: columns ``id``, ``text``, ``bucket``,
    ``ghost``, so that within a bucket, ordered by (ghost, id, tie), every row
    is followed by its successor in the whole table's order.

    Buckets are ranges of ids between approximate quantiles; a bucket's first
    row is sent a second time, as a ghost, to the end of the bucket before
    (and the very first row to the last bucket). Only one id per bucket
    reaches the driver; each text is shuffled once.
    """
    spark = df.sparkSession
    buckets = 8 * shuffle_partitions(spark)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    cuts = sorted(set(rows.select("id").approxQuantile("id", [i / buckets for i in range(1, buckets)], 1 / (4 * buckets)))) \
        if buckets > 1 else []
    cuts = [int(c) for c in cuts]

    @F.pandas_udf("int")
    def bucket_of(ids: pd.Series) -> pd.Series:
        null = ids.isna()
        at = np.searchsorted(np.array(cuts, dtype=np.int64), ids.fillna(0).to_numpy(np.int64), "right") + 1
        return pd.Series(np.where(null, 0, at)).astype("int32")

    rows = rows.withColumn("bucket", bucket_of("id").cast("int")).withColumn("tie", F.xxhash64("text"))
    heads = (rows.groupBy("bucket").agg(F.min(F.struct("id", "tie")).alias("h"))
             .select("bucket", "h.id", "h.tie").orderBy("bucket").collect())
    before = [(h["id"], h["tie"], heads[i - 1]["bucket"]) for i, h in enumerate(heads)]
    h = F.broadcast(spark.createDataFrame(before, "hid long, htie long, to_bucket int"))  # a row per bucket
    both = rows.join(h, rows["id"].eqNullSafe(h["hid"]) & (rows["tie"] == h["htie"]), "left")
    copies = F.array(F.struct(F.col("bucket").alias("b"), F.lit(0).alias("g")),
                     F.struct(F.col("to_bucket").alias("b"), F.lit(1).alias("g")))
    both = both.select("id", "text", "tie", F.explode(copies).alias("c"))
    both = both.where(F.col("c.b").isNotNull()).select("id", "text", "tie", F.col("c.b").alias("bucket"), F.col("c.g").alias("ghost"))
    return (both.repartition(shuffle_partitions(spark), "bucket")
            .sortWithinPartitions("bucket", "ghost", F.col("id").asc_nulls_first(), "tie"))


def fingerprint_edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id``, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``.

    A null text is empty. Null ids sort first, repeated ids by a hash of their
    text. A single row is its own successor. Memory holds two texts' arrays
    at a time, whatever the partition's size.
    """
    def run(batches):
        import pyarrow as pa
        held = None  # the row waiting for its successor
        out = []

        def done(cur, nxt):
            rid, text, h, f = cur
            half = h.n // 2
            keep = h.n - half
            tail = nxt[1][:half]
            e = Spliced(h, keep, nxt[2], len(tail))
            ef = fingerprint(e)
            edited = (text[:keep] + tail).encode("utf-8", "surrogatepass")
            out.append((rid, h.n, hashlib.sha256(edited).hexdigest(), f, ef, likeness(f, ef), likeness(f, nxt[3])))

        names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

        def flush():
            cols = list(zip(*out, strict=True)) or [()] * len(names)
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)
            out.clear()
            return batch

        for b in batches:
            for rid, text, bucket, ghost in zip(*(b.column(c).to_pylist() for c in ("id", "text", "bucket", "ghost")), strict=True):
                if ghost and (held is None or held[0] != bucket):
                    continue  # a repeated head row: its bucket already has its ghost
                h = PrefixHash(text)
                row = (rid, text, h, fingerprint(h))
                if held is not None and held[0] == bucket:
                    done(held[1], row)
                held = None if ghost else (bucket, row)
                if len(out) >= 1000:
                    yield flush()
        yield flush()

    pairs = edit_pairs(df, id_col, text_col).select("id", "text", "bucket", "ghost")
    return pairs.mapInArrow(run, "id long, n_chars long, edited_sha256 string, fingerprint string, "
                                 "edited_fingerprint string, near_edited double, near_next double")


def op2_fingerprint(spark, sf_dir: str) -> DataFrame:
    """Prefix-hash fingerprints of all documents and their edited texts."""
    return fingerprint_edits(read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
