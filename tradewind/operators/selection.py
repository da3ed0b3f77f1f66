"""Exact percentiles per group by distributed selection.

No group is sorted or gathered in one task. A round counts each group's values
in the bins of a range histogram (partial counts in every task, merged by key),
finds the bin that holds the wanted rank, and goes on inside that bin's least and
greatest value. Bins are even in the logarithm while a range spans magnitudes,
else even in the value. Bins that hold few rows are ranked by value at the end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import shared_dir

BINS = 4096
WIDE = 8  # span of logarithms from which bins are even in them
FEW = 10_000  # rows of a bin that one task may rank


def _magnitude(c):
    """Ascends with the value: its logarithm above the least double's, with its sign."""
    return F.when(F.col(c) == 0, 0.0).otherwise(F.signum(c) * (F.log(F.abs(c)) + 746))


def _stored(df: DataFrame) -> DataFrame:
    path = shared_dir(df.sparkSession, "selection")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exact_percentiles(df: DataFrame, group_cols: Sequence[str], value_col: str, probs: Sequence[float],
                      bins: int = BINS, few: int = FEW) -> DataFrame:
    """Per group and ``prob``: ``value``, the least value that at least that
    share of the group's values does not exceed (``percentile_disc``). Nulls and
    NaN are left out, infinities are values, a null group is a group; a group
    without values has no row. A range's least and greatest value always fall
    into two bins, so each round splits: one or two rounds as a rule, some ten
    on doubles of all magnitudes."""
    if any(not 0 <= p <= 1 for p in probs):
        raise ValueError("probabilities lie between 0 and 1")
    keys = [f"_k{i}" for i in range(len(group_cols))]
    v = F.col(value_col).cast("double")
    values = df.select(*[F.col(c).alias(k) for c, k in zip(group_cols, keys, strict=True)], v.alias("v")).where("v is not null and not isnan(v)")
    finite = F.when(F.abs("v") < float("inf"), F.col("v"))
    sizes = values.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(finite).alias("lo"), F.max(finite).alias("hi"))
    prob = F.explode(F.array(*[F.lit(float(p)) for p in probs]))
    rank = F.greatest(F.lit(1), F.col("n") - F.floor(F.col("n") - F.col("prob") * F.col("n"))).cast("long")
    # The range is open for the first round, so that infinities fall in bins of their own.
    targets = _stored(sizes.select("*", prob.alias("prob")).select(*keys, "prob", rank.alias("rank"), F.col("n").alias("rows"), "lo", "hi",
                                                                   F.lit(True).alias("first")))
    same = [F.col(f"t.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]

    def inside(t):
        """Rows in their targets' ranges."""
        within = F.col("t.first") | F.col("r.v").between(F.col("t.lo"), F.col("t.hi"))
        joined = values.alias("r").join(t.alias("t"), [*same, within] if same else within)
        return joined.select(*[F.col(f"t.{k}") for k in keys], "t.prob", "t.rank", "t.lo", "t.hi", "r.v")

    def at_rank(counted, order):
        """The row of each target that holds its rank; ranks count from there on."""
        before = F.sum("rows").over(W.partitionBy(*keys, "prob").orderBy(order)) - F.col("rows")
        return counted.withColumn("_before", before).where("_before < rank and rank <= _before + rows").withColumn("rank", F.col("rank") - F.col("_before"))

    done = []
    while True:
        live = targets.where(f"first or (lo < hi and rows > {few})")
        if live.isEmpty():
            break
        done.append(targets.where(f"not first and (lo = hi or rows <= {few})"))
        # Halves: the width of the widest range of doubles is no double.
        even = (F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
        span = _magnitude("hi") - _magnitude("lo")
        place = F.floor(F.when(span > WIDE, (_magnitude("v") - _magnitude("lo")) / span).otherwise(even) * bins)
        number = (F.when(F.col("v") == float("-inf"), -1).when(F.col("v") == float("inf"), bins)
                  .when(F.col("lo") == F.col("hi"), 0).otherwise(F.least(place, F.lit(bins - 1))))
        hist = inside(live).groupBy(*keys, "prob", "rank", number.alias("bin")).agg(
            F.count(F.lit(1)).alias("rows"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        targets = _stored(at_rank(hist, "bin").select(*keys, "prob", "rank", "rows", "lo", "hi", F.lit(False).alias("first")))
    done.append(targets)
    every = done[0]
    for t in done[1:]:
        every = every.unionByName(t)
    sure = every.where("not first and lo = hi").select(*keys, "prob", F.col("lo").alias("v"))
    counted = inside(every.where("not first and lo < hi")).groupBy(*keys, "prob", "rank", "v").agg(F.count(F.lit(1)).alias("rows"))
    found = sure.unionByName(at_rank(counted, "v").select(*keys, "prob", "v"))
    return found.select(*[F.col(k).alias(c) for k, c in zip(keys, group_cols, strict=True)], "prob", F.col("v").alias("value"))
