"""Most frequent values with bounded memory (A10).

Each task keeps a Misra-Gries summary of at most ``capacity`` values; what a
summary drops lowers a value's count by at most the sum of its cuts. So a value
in no summary occurs at most ``bound`` times in all, ``bound`` being the sum of
all tasks' cuts, and the values in the summaries are counted exactly in a second
pass. If the n-th of them occurs more often than ``bound``, the report is
proved; else the summaries are taken again with four times the room, and past
``most`` every value is counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir
from .stats import frequency_profile

CAPACITY = 4096
MOST = 1 << 20


def summaries(df: DataFrame, column: str, capacity: int) -> DataFrame:
    """Per task, ``value`` with at least ``n`` occurrences there, at most
    ``capacity`` of them, and one row with a null value whose ``n`` is the most
    occurrences that the task left out of any value's count."""
    kind = dict(df.dtypes)[column]
    rows = df.select(F.col(column).alias("value")).where("value is not null")

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        values, counts, cut = None, None, 0
        for b in batches:
            seen = pc.value_counts(b.column("value"))
            v, n = seen.field(0), seen.field(1)
            if values is not None:
                both = pa.table({"v": pa.concat_arrays([values, v]), "n": pa.concat_arrays([counts, n])}).group_by("v").aggregate([("n", "sum")])
                v, n = both.column("v").combine_chunks(), both.column("n_sum").combine_chunks()
            if len(v) > capacity:
                each = n.to_numpy()
                off = int(np.partition(each, len(each) - capacity - 1)[len(each) - capacity - 1])  # the greatest that must go
                cut += off
                stay = pa.array(each > off)
                v, n = v.filter(stay), pc.subtract(n.filter(stay), off)
            values, counts = v, n
        if values is not None:
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([values, pa.nulls(1, values.type)]), pa.concat_arrays([counts, pa.array([cut], pa.int64())])],
                                             names=["value", "n"])

    return rows.mapInArrow(run, f"value {kind}, n long")


def heavy_hitters(df: DataFrame, column: str, top_n: int, capacity: int = CAPACITY, most: int = MOST) -> DataFrame:
    """The ``top_n`` most frequent values and their exact ``count``, most
    frequent first, ties by value; nulls are left out. Equal to
    ``frequency_profile``, without a shuffle of every distinct value."""
    spark = df.sparkSession
    while capacity <= most:
        path = shared_dir(spark, "summaries")
        found = summaries(df, column, capacity)
        found.write.parquet(path)
        stored = spark.read.schema(found.schema).parquet(path)
        bound = stored.where("value is null").agg(F.sum("n")).first()[0] or 0
        kept = stored.where("value is not null").select(F.col("value").alias("_value")).distinct()
        exact = frequency_profile(df.join(kept, F.col(column) == F.col("_value"), "left_semi"), column, top_n)
        if bound == 0:  # nothing was left out
            return exact
        last = exact.agg(F.count(F.lit(1)).alias("n"), F.min("count").alias("least")).first()
        if last["n"] == top_n and last["least"] > bound:
            return exact
        capacity *= 4
    return frequency_profile(df, column, top_n)
