"""What a consumer lost: gaps in the offsets of each topic partition.

With ``failOnDataLoss=false`` a reader goes on when retention has removed
messages it had not read. The stored rows then show islands of offsets with gaps
between them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import shared_dir

_RUNS = "part int, p long, first long, last long, lost boolean"


def lost_ranges(df: DataFrame, partition_col: str = "partition", offset_col: str = "offset") -> DataFrame:
    """``partition``, ``first_lost``, ``last_lost``, ``lost`` (how many): the
    offsets missing between the least and the greatest of each partition.
    Redelivered offsets and null ones do not matter.

    Rows are range-partitioned by (partition, offset), so a hot topic partition
    spreads over tasks. Each task walks its sorted offsets and writes its gaps,
    and one row with its first and last offset; gaps between tasks are found on
    these rows alone, two a task and topic partition at most."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (df.select(F.col(partition_col).cast("long").alias("p"), F.col(offset_col).cast("long").alias("o"))
              .where("p is not null and o is not null")
              .repartitionByRange(n, "p", "o").sortWithinPartitions("p", "o"))

    def walk(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        begin, last = None, None

        def table(p, first, end, lost):
            k = len(p)
            return pa.RecordBatch.from_arrays([pa.array(np.full(k, part, dtype=np.int32)), pa.array(p), pa.array(first), pa.array(end),
                                               pa.array(np.full(k, lost))], names=["part", "p", "first", "last", "lost"])

        for b in batches:
            p, o = b.column("p").to_numpy(), b.column("o").to_numpy()
            if not len(p):
                continue
            if last is None:
                begin = (p[0], o[0])
            else:  # the last row of the batch before
                p, o = np.r_[last[0], p], np.r_[last[1], o]
            last = (p[-1], o[-1])
            gap = np.flatnonzero((p[1:] == p[:-1]) & (o[1:] - o[:-1] > 1))
            yield table(p[gap], o[gap] + 1, o[gap + 1] - 1, True)
        if last is not None:  # from its first row to its last, as two rows
            yield table(np.array([begin[0], last[0]]), np.array([begin[1], last[1]]), np.array([begin[1], last[1]]), False)

    staged = shared_dir(spark, "offsets")
    rows.mapInArrow(walk, _RUNS).write.parquet(staged)
    found = spark.read.schema(_RUNS).parquet(staged)
    # Two rows a task: its ends. One window over them finds the gaps between.
    order = W.orderBy("part", "p", "first")
    ends = found.where("not lost").select("p", F.col("first").alias("o"), F.lag("p").over(order).alias("before_p"),
                                          F.lag("last").over(order).alias("before"), "part", F.lag("part").over(order).alias("before_part"))
    between = ends.where("p = before_p and part <> before_part and o - before > 1").select(
        "p", (F.col("before") + 1).alias("first"), (F.col("o") - 1).alias("last"))
    gaps = found.where("lost").select("p", "first", "last").unionByName(between)
    return gaps.select(F.col("p").alias("partition"), F.col("first").alias("first_lost"), F.col("last").alias("last_lost"),
                       (F.col("last") - F.col("first") + 1).alias("lost"))
