"""Consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points on a 64-bit ring; a key belongs to the
first point clockwise from its hash. A shard takes no more keys than its
capacity; keys that find it full go on clockwise to the next shard with room.

All keys on one arc (between two neighbouring points) share one clockwise
order of shards, so the walk needs only the number of keys per arc: at most
``n_shards * vnodes`` counts reach the driver, whatever the input size. Rows
are numbered inside their arc in hash order (range partitions of narrow rows,
a counter per partition, offsets of earlier partitions), and the walk's answer
is a list of ranges of these numbers. Slots in a shard follow from the same
ranges. A hot key is dealt over many range partitions by a running row id.
"""
from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewind.llm.common import materialize, read

SHARDS = 8
VNODES = 128


def ring_points(n_shards: int, vnodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted point positions (signed 64-bit) and the shard owning each."""
    pos, own = [], []
    for s in range(n_shards):
        for v in range(vnodes):
            d = hashlib.blake2b(f"shard {s} node {v}".encode(), digest_size=8).digest()
            pos.append(int.from_bytes(d, "big", signed=True))
            own.append(s)
    order = np.argsort(np.array(pos, dtype=np.int64), kind="stable")
    return np.array(pos, dtype=np.int64)[order], np.array(own)[order]


def capacities(total: int, n_shards: int, slack: float) -> list[int]:
    """``slack`` 0: counts at most one apart and exactly ``total`` in sum;
    else ``ceil((1 + slack) * mean)`` for every shard."""
    if slack > 0:
        return [-int(-(1 + slack) * total // n_shards)] * n_shards
    return [total // n_shards + (s < total % n_shards) for s in range(n_shards)]


def walk(counts: dict[int, int], owners, caps: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Ranges ``(arc, lo, hi, shard, base)``: keys numbered lo..hi-1 of an arc
    go to ``shard``, at slots from ``base`` on. Shards first take the keys of
    their own arcs, which keeps every key at home that fits there; what
    overflows walks clockwise."""
    free, used, out, left = list(caps), [0] * len(caps), [], {}

    def take(arc, lo, want, shard):
        n = min(want, free[shard])
        if n:
            out.append((arc, lo, lo + n, shard, used[shard]))
            free[shard] -= n
            used[shard] += n
        return n

    for arc in sorted(counts):
        n = take(arc, 0, counts[arc], int(owners[arc]))
        if n < counts[arc]:
            left[arc] = n
    for arc, lo in left.items():
        at = arc
        while lo < counts[arc]:
            at = (at + 1) % len(owners)
            lo += take(arc, lo, counts[arc] - lo, int(owners[at]))
    return out


def bounded_ring(df: DataFrame, key: str, carry: list[str], n_shards: int = SHARDS,
                 vnodes: int = VNODES, slack: float = 0.0) -> DataFrame:
    """Rows of ``df`` with columns ``carry`` plus ``shard`` int, ``slot`` long
    (gapless from 0 in each shard) and ``home`` int (the shard without a load
    bound).

    Null keys are one key; equal keys may be split where a shard is full;
    an empty table gives an empty result. Columns other than ``carry`` are
    not kept, so their names cannot clash.
    """
    spark = df.sparkSession
    points, owners = ring_points(n_shards, vnodes)
    carried = [F.col(c).alias(f"c{i}") for i, c in enumerate(carry)]
    rows = df.select(*carried, F.xxhash64(key).alias("pos"), F.monotonically_increasing_id().alias("rid"))
    rows = rows.withColumn("tie", F.xxhash64("pos", *[f"c{i}" for i in range(len(carry))]))
    rows = rows.repartitionByRange("pos", "tie", "rid").sortWithinPartitions("pos", "tie", "rid")
    keep = [f"c{i}" for i in range(len(carry))]

    def number(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        part, seen = TaskContext.get().partitionId(), np.zeros(len(points), dtype=np.int64)
        for b in batches:
            arc = np.searchsorted(points, b.column("pos").to_numpy(), "left") % len(points)
            # Rank among equal arcs of the batch, in row order.
            order = np.argsort(arc, kind="stable")
            first = np.r_[True, np.diff(arc[order]) != 0]
            start = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
            idx = np.empty(len(order), dtype=np.int64)
            idx[order] = np.arange(len(order)) - start
            idx += seen[arc]
            seen += np.bincount(arc, minlength=len(points))
            cols = [b.column(c) for c in keep]
            cols += [pa.array(arc.astype(np.int32)), pa.array(np.full(len(arc), part, np.int32)), pa.array(idx)]
            yield pa.RecordBatch.from_arrays(cols, names=[*keep, "arc", "part", "idx"])

    kinds = dict(rows.dtypes)
    schema = ", ".join([f"{c} {kinds[c]}" for c in keep] + ["arc int, part int, idx long"])
    rows = materialize(rows.mapInArrow(number, schema), "ring")

    by_part = rows.groupBy("arc", "part").agg(F.count("*").alias("n"))
    before = W.partitionBy("arc").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = by_part.select("arc", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    counts = {r["arc"]: r["n"] for r in by_part.groupBy("arc").agg(F.sum("n").alias("n")).collect()}
    caps = capacities(sum(counts.values()), n_shards, slack)
    ranges = spark.createDataFrame(walk(counts, owners, caps),
                                   "arc int, lo long, hi long, shard int, base long")
    home = spark.createDataFrame([(i, int(s)) for i, s in enumerate(owners)], "arc int, home int")
    # Broadcasts: a row per ring point, per range (points + shards at most),
    # and per range partition and arc it holds (partitions + points).
    placed = (rows.join(F.broadcast(offsets), ["arc", "part"])
              .withColumn("rank", F.col("idx") + F.col("offset"))
              .join(F.broadcast(home), "arc"))
    r = F.broadcast(ranges.withColumnRenamed("arc", "at"))
    placed = placed.join(r, (placed["arc"] == r["at"]) & (placed["rank"] >= r["lo"]) & (placed["rank"] < r["hi"]))
    return placed.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], "shard",
                         (F.col("base") + F.col("rank") - F.col("lo")).alias("slot"), "home")


def op1_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents on a bounded-load ring of 8 shards, law ``rows``: shard
    counts are at most one apart. A null text has size 1 and crc32 0."""
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    docs = read(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"))
    out = bounded_ring(docs, "doc_id", ["doc_id", "size", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), F.col("home").alias("home_shard"))
