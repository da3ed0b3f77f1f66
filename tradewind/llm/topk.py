"""Exact top-k inner products without random access.

The query rows are dealt in blocks to cells of candidate rows, so each task
streams candidates past one block of queries. For a block of candidates there
is one sorted list per component, read from the top for queries whose component
is positive and from the bottom where it is negative. After reading all lists
to a depth, a candidate's score lies between bounds: the components read, plus
the list's frontier (upper) or its far end (lower) for those not yet read. A
pair whose upper bound is below its query's k-th lower bound cannot qualify. The
lists are read on, each time half of what is left, until no more than
``RESOLVE`` of the block's pairs are open; only these pairs' scores are then
resolved, one by one. Equal scores go to the smaller id.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewind.llm.common import materialize, read, shuffle_partitions

K = 20
SCALE = 64
ASKED = 16_384     # queries that a candidate is sent to at a time
QUERIES = 2048     # of them that are bounded together
CANDIDATES = 4096  # in a block of candidates
RESOLVE = 1 / 20   # share of open pairs at which reading stops
PAIRS = 50_000     # resolved at a time
LARGEST = 1 << 26  # of a component times the scale; 1024 products of two then fit 64 bits


def quantized(df: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """``rid`` (names the row), ``id``, ``v`` array<long>: floor(scale * x) of
    every component; rows with a null id, a null vector, or a null or
    non-finite component are left out. Shorter vectors count as padded with 0. A
    component of ``LARGEST`` or more after scaling is an error."""
    def whole(c):
        return F.when(F.abs(c * scale) < LARGEST, F.floor(c * scale).cast("long")).otherwise(F.raise_error(F.lit("a vector's component is too large")))

    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & fine)
    rows = rows.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("id"), x.alias("x"))
    return rows.select("rid", "id", F.transform("x", whole).alias("v"))


class NoRandomAccess:
    """Top k of candidates streamed past a block of queries."""

    def __init__(self, rids, ids, vectors: np.ndarray, k: int):
        self.rids, self.ids, self.q, self.k = np.asarray(rids), np.asarray(ids), vectors, k
        self.best = np.zeros((0, 4), dtype=np.int64)  # query, score, id, rid
        self.floor = np.full(len(vectors), -np.inf)   # k-th score so far
        self.seen = self.resolved = 0                 # pairs, and those whose score was resolved

    def _raise(self, queries: np.ndarray, known: np.ndarray) -> None:
        """Raise the queries' floors to the k-th of scores known at least."""
        at = known.shape[1] - self.k
        self.floor[queries] = np.maximum(self.floor[queries], np.partition(known, at, axis=1)[:, at])

    def add(self, rids: np.ndarray, ids: np.ndarray, c: np.ndarray) -> None:
        most = float(np.abs(c).max(initial=0)) * float(np.abs(self.q).sum(axis=1).max(initial=0))
        kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64  # exact in each
        c, q = c.astype(kind), self.q.astype(kind)
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        low, high = c.min(axis=0), c.max(axis=0)
        lists = np.sort(c, axis=0)
        open_ = self.rids[:, None] != rids[None, :]
        self.seen += open_.size
        left = 1.0  # of the lists
        while open_.sum() > RESOLVE * open_.size and left * len(c) >= 1:
            left *= 3 / 4 if left == 1 else 1 / 2
            at = max(1, int((1 - left) * len(c)))
            top, bottom = lists[len(c) - at], lists[at - 1]  # frontiers of the lists from either end
            queries, rows = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
            part, here = c[rows], open_[np.ix_(queries, rows)]
            if len(rows) > self.k:
                lower = up[queries] @ np.where(part >= top, part, low).T + down[queries] @ np.where(part <= bottom, part, high).T
                self._raise(queries, np.where(here, lower, -np.inf))
            upper = up[queries] @ np.maximum(part, top).T + down[queries] @ np.minimum(part, bottom).T
            open_[np.ix_(queries, rows)] = here & (upper >= self.floor[queries][:, None])
        s, r = np.nonzero(open_)
        if not len(s):
            return
        self.resolved += len(s)
        score = np.concatenate([np.einsum("ij,ij->i", q[s[a:a + PAIRS]], c[r[a:a + PAIRS]]) for a in range(0, len(s), PAIRS)])
        good = score >= self.floor[s]
        s, r, score = s[good], r[good], score[good]
        new = np.stack([s, score.astype(np.int64), ids[r], rids[r]], axis=1)
        every = np.concatenate([self.best, new])
        every = every[np.lexsort((every[:, 3], every[:, 2], -every[:, 1], every[:, 0]))]
        first = np.searchsorted(every[:, 0], np.arange(len(self.q) + 1))
        self.best = every[np.arange(len(every)) - first[every[:, 0]] < self.k]
        full = np.diff(np.searchsorted(self.best[:, 0], np.arange(len(self.q) + 1)))
        last = np.cumsum(full) - 1
        done = full == self.k
        self.floor[done] = np.maximum(self.floor[done], self.best[last[done], 1])


def top_k(df: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, scale: int = SCALE) -> DataFrame:
    """For each row where ``is_query`` (a column over ``id``) holds: its ``k``
    candidates with the highest integer inner products, as ``query_id``,
    ``rank``, ``vec_id``, ``score``. Every other row is a candidate, a repeated
    id too. An empty table gives an empty result."""
    spark = df.sparkSession
    rows = materialize(quantized(df, id_col, vector_col, scale), "vectors")
    sizes = rows.agg(F.max(F.size("v")).alias("d"), F.count(F.when(is_query, 1)).alias("q"), F.count("*").alias("n")).first()
    width, blocks = sizes["d"] or 0, max(1, -(-sizes["q"] // ASKED))
    cells = max(1, min(2 * shuffle_partitions(spark), -(-sizes["n"] // CANDIDATES)))  # each a block or more
    deal = F.pmod(F.xxhash64("rid"), F.lit(blocks))
    asked = rows.where(is_query).select("rid", "id", "v", F.lit(0).alias("kind"), deal.cast("int").alias("block"),
                                        F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("cell"))
    given = rows.select("rid", "id", "v", F.lit(1).alias("kind"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
                        F.pmod(F.xxhash64("rid", F.lit("cell")), F.lit(cells)).cast("int").alias("cell"))
    both = asked.unionByName(given).repartition(shuffle_partitions(spark), "block", "cell")
    both = both.sortWithinPartitions("block", "cell", "kind", "rid").select("block", "cell", "kind", "rid", "id", "v")

    def run(batches):
        import pyarrow as pa
        key, searches, held, asking = None, [], [], []

        def stack(parts):
            cols = [np.concatenate([p[i] for p in parts]) for i in range(3)]
            parts.clear()
            return cols

        def look(rids, ids, vectors):
            for search in searches:
                search.add(rids, ids, vectors)

        def result():
            if searches and held:
                look(*stack(held))
            for search in searches:
                b = search.best
                yield pa.RecordBatch.from_arrays([pa.array(search.rids[b[:, 0]]), pa.array(search.ids[b[:, 0]]), *[pa.array(b[:, i].copy()) for i in (2, 1, 3)]],
                                                 names=["query", "query_id", "vec_id", "score", "rid"])

        for b in batches:
            if not b.num_rows:
                continue
            lists, v = b.column("v"), np.zeros((b.num_rows, width), dtype=np.int64)
            n = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            if (n == width).all():
                v = flat.reshape(-1, width)
            else:
                v[np.repeat(np.arange(len(n)), n), np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)] = flat
            cols = [b.column(c).to_numpy() for c in ("block", "cell", "kind", "rid", "id")]
            change = np.flatnonzero(np.any([np.diff(c) != 0 for c in cols[:3]], axis=0)) + 1
            for lo, hi in zip(np.r_[0, change].tolist(), np.r_[change, b.num_rows].tolist(), strict=True):
                if key != (cols[0][lo], cols[1][lo]):
                    yield from result()
                    key = (cols[0][lo], cols[1][lo])
                    searches, held, asking = [], [], []
                part = (cols[3][lo:hi], cols[4][lo:hi], v[lo:hi])
                if cols[2][lo] == 0:
                    asking.append(part)
                    continue
                if asking:
                    every = stack(asking)
                    searches = [NoRandomAccess(*[x[a:a + QUERIES] for x in every], k) for a in range(0, len(every[0]), QUERIES)]
                if searches:  # else candidates without a query
                    held.append(part)
                    while sum(len(p[0]) for p in held) >= CANDIDATES:
                        every = stack(held)
                        look(*[x[:CANDIDATES] for x in every])
                        held.append(tuple(x[CANDIDATES:] for x in every))
        yield from result()

    near = both.mapInArrow(run, "query long, query_id long, vec_id long, score long, rid long")
    order = W.partitionBy("query").orderBy(F.desc("score"), "vec_id", "rid")
    return (near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op5_topk(spark, sf_dir: str) -> DataFrame:
    """Top 20 of every vector whose id is divisible by 20, against all rows."""
    return top_k(read(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


OP5_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
      FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
