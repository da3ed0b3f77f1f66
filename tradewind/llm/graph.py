"""Connected components of an edge table, by alternating star contraction."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """``(node, comp)`` for every node of ``edges(u, v)``, ``comp`` being the
    smallest node reachable. Each round hooks larger neighbours, then smaller
    ones, onto the smallest; rounds grow with the logarithm of the number of
    nodes. Nulls and loops are ignored. Minima are combined before they are
    shuffled and hubs meet them in joins that Spark can split."""
    e = materialize(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")

    def mark(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = mark(e)
    while before[0]:
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
        e = materialize(small.select("x.u", "x.v").where("u <> v").distinct(), "edges")
        after = mark(e)
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(e.select("v", "v").distinct())
