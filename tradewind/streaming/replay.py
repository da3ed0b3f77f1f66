"""An ordered replay of a table as a stream of bounded batches.

The rows are dealt into files of at most ``rows_per_file`` in the order of their
arrival, one file after another, and the files' modification times ascend, which
is the order in which the file source hands them out. With ``maxFilesPerTrigger``
a micro-batch is then a bounded stretch of the log, the watermark moves on batch
by batch, and rows that arrive late are late.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import remove_path, shared_dir

# Modification times of a log's files: from here on, this many ms apart.
FIRST_FILE_MS = 1_600_000_000_000
FILE_STEP_MS = 1000
FILE = "_replay_file"


def ranked(df: DataFrame, order_by: Sequence[str], rank_col: str = "_rank", tasks: int | None = None) -> DataFrame:
    """``df`` with its rows' exact places (from 0) in the order of ``order_by``,
    ties in any order. Rows are range-partitioned and sorted, and written once,
    so that their places within a partition hold; only counts per partition are
    added up. The staged table stays in the shared folder until the session ends. ``tasks``
    is the number of range partitions (that of shuffles by default)."""
    spark = df.sparkSession
    staged = shared_dir(spark, "ranked")
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    n = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(n, *order_by).sortWithinPartitions(*order_by)
       .withColumns({"_part": F.spark_partition_id(), "_at": within}).write.option("compression", "zstd").parquet(staged))
    places = [T.StructField("_part", T.IntegerType()), T.StructField("_at", T.LongType())]
    rows = spark.read.schema(T.StructType([*df.schema.fields, *places])).parquet(staged)
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # one row a partition
    before = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).select(
        "_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    return (rows.join(F.broadcast(before), "_part")  # as many rows as range partitions
            .withColumn(rank_col, F.col("_at") + F.col("_before")).drop("_part", "_at", "_before"))


def _found(df: DataFrame, key: Column, keys: Column, n: int, name: str) -> DataFrame:
    """``df`` with the column ``name``: how many of ``keys``, an ascending array of
    ``n`` from one row, are at most ``key``."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(max(1, n.bit_length())))])
    at = F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= n) & (F.get("_keys", at + step - 1) <= F.col("_key")), at + step).otherwise(at))
    return df.withColumns({"_keys": keys, "_key": key}).withColumn(name, at)


def _dealt(df: DataFrame, order: Sequence[Column], file_of: Callable[[Column], Column], tasks: int | None) -> tuple[DataFrame, int]:
    """``df`` with the file of each row, and the number of files. Only the
    order's values are ranked; rows find their file between the first values of
    the files. Rows equal to a value that reaches over such a border are ranked."""
    spark = df.sparkSession
    names = [f"k{i}" for i in range(len(order))]
    places = ranked(df.select(*[o.alias(k) for o, k in zip(order, names, strict=True)]), names, tasks=tasks)
    places = places.select(F.struct(*names).alias("key"), "_rank")
    last = places.agg(F.max("_rank")).first()[0]
    if last is None:
        return df, 0
    rank, files = F.col("_rank"), spark.range(1).select(file_of(F.lit(last))).first()[0] + 1
    key = F.struct(*[o.alias(k) for o, k in zip(order, names, strict=True)])
    # One row a border: the value after it, and whether the one before is equal.
    starts = places.where((rank > 0) & (file_of(rank) > file_of(rank - 1))).select(file_of(rank).alias("border"), "key")
    ends = places.where((rank < last) & (file_of(rank) < file_of(rank + 1))).select((file_of(rank) + 1).alias("border"), F.col("key").alias("before"))
    path = shared_dir(spark, "borders")
    starts.join(ends, "border").withColumn("tied", F.col("key") == F.col("before")).write.parquet(path)
    borders = spark.read.parquet(path)
    first_values = borders.agg(F.sort_array(F.collect_list("key"))).scalar()
    tied = borders.where("tied").select("key").distinct()
    n = tied.count()
    if not n:
        return _found(df, key, first_values, files - 1, FILE).drop("_keys", "_key"), files
    values = tied.agg(F.sort_array(F.collect_list("key"))).scalar()
    is_tied = F.coalesce(F.get("_keys", F.col("_nth") - 1) == F.col("_key"), F.lit(False))
    found = _found(df, key, values, n, "_nth").withColumn("_tied", is_tied).drop("_keys", "_key")
    alone = _found(found.where(~F.col("_tied")).select(*df.columns), key, first_values, files - 1, FILE)
    counted = _found(places, F.col("key"), values, n, "_nth").where(is_tied).groupBy("_nth").agg(F.min("_rank").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = W.orderBy("_nth").rowsBetween(W.unboundedPreceding, -1)  # one row a tied value
    shift = counted.select("_nth", (F.col("first") - F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("_shift"))
    ties = ranked(found.where("_tied").drop("_tied"), ["_nth"], tasks=tasks).join(F.broadcast(shift), "_nth")
    return alone.select(*df.columns, FILE).unionByName(ties.withColumn(FILE, file_of(rank + F.col("_shift"))).select(*df.columns, FILE)), files


def write_replay_log(df: DataFrame, path: str, order_by: Sequence[str | Column], rows_per_file: int,
                     columns: Sequence[str] | None = None, encode: Callable[[DataFrame], DataFrame] | None = None,
                     split: int = 1, tasks: int | None = None) -> int:
    """Write ``columns`` of ``df`` (all by default) as an ordered log at ``path``;
    returns the number of files. File k holds the rows ranked ``k *
    rows_per_file`` on, in order, so neither a file nor a batch outgrows it.
    ``df`` is read twice, for its order and for its rows.

    ``encode`` (row by row) makes the log's rows of the ordered rows of ``df`` as
    they are written, so that messages are not shuffled; ``columns`` are then its.
    With ``split`` each such stretch of rows is dealt evenly over that many files,
    still in order, for batches too large for one task. ``tasks`` is for ``ranked``.

    The file system must keep modification times that are set (HDFS and local
    ones do; an error says if not)."""
    if rows_per_file < 1:
        raise ValueError("rows_per_file must be 1 or more")
    if not 1 <= split <= rows_per_file:
        raise ValueError("split must be 1 to rows_per_file")
    spark = df.sparkSession
    encode = encode or (lambda rows: rows)
    columns = list(columns or encode(df).columns)
    order = [F.col(o) if isinstance(o, str) else o for o in order_by]

    def file_of(rank: Column) -> Column:
        batch = F.floor(rank / rows_per_file)
        return (batch * split + F.floor((rank - batch * rows_per_file) * split / rows_per_file)).cast("int")
    rows, files = _dealt(df, order, file_of, tasks)
    if not files:  # no rows: an empty log with a schema
        encode(df).select(*columns).limit(0).write.mode("overwrite").parquet(path)
        return 0
    ordered = rows.repartitionById(files, FILE).sortWithinPartitions(*order).drop(FILE)
    encode(ordered).select(*columns).write.mode("overwrite").option("compression", "zstd").parquet(path)
    order_files(spark, path)
    return files


def order_files(spark: SparkSession, path: str) -> None:
    """Give the part files of ``path`` ascending modification times, by name.
    One metadata call a file."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted((s.getPath().getName(), s.getPath()) for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-"))
    for k, (_, p) in enumerate(names):
        fs.setTimes(p, FIRST_FILE_MS + k * FILE_STEP_MS, -1)
    if names and fs.getFileStatus(names[-1][1]).getModificationTime() != FIRST_FILE_MS + (len(names) - 1) * FILE_STEP_MS:
        raise RuntimeError(f"{path}: the file system does not keep modification times")


def read_replay(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """The log as a stream; a micro-batch takes ``files_per_trigger`` files."""
    schema = spark.read.parquet(path).schema
    # Files far apart in time must not count as too old.
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .option("maxFileAge", "36500d").parquet(path))


def remove_log(spark: SparkSession, path: str) -> None:
    """Drop a log that no stream reads any more."""
    remove_path(spark, path)
