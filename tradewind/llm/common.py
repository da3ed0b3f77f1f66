"""Helpers shared by the operators of this subpackage."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.session import shared_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and read it back:
    cuts the lineage and fixes partition numbers, so a lost executor costs a
    re-read and never a different answer."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_batches(batch, columns, max_chars: int = 4_000_000):
    """Slice an Arrow batch so that the texts in ``columns`` of one slice hold
    at most ``max_chars`` bytes (a single longer row is a slice of its own)."""
    import numpy as np
    sizes = np.zeros(batch.num_rows, dtype=np.int64)
    for c in columns:
        col = batch.column(c)
        off = np.frombuffer(col.buffers()[1], dtype=np.int64 if "large" in str(col.type) else np.int32)
        off = off[col.offset:col.offset + batch.num_rows + 1]
        sizes += np.diff(off)
    start, acc = 0, 0
    for i, s in enumerate(sizes.tolist()):
        if acc and acc + s > max_chars:
            yield batch.slice(start, i - start)
            start, acc = i, 0
        acc += s
    if batch.num_rows > start:
        yield batch.slice(start)


def give_back():
    """Return freed memory to the system. A Python worker outlives its tasks, and
    glibc keeps the freed arrays of one stage while the next asks for its own."""
    import contextlib
    import ctypes
    with contextlib.suppress(OSError, AttributeError, TypeError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


def in_one_task(rows: DataFrame, fit):
    """``fit(list of dicts)`` over ``rows``, a sample of bounded size, in one
    task: the rows and the work stay off the driver, which gets the result."""
    def run(batches):
        import pickle

        import pyarrow as pa
        give_back()
        got = fit([r for b in batches for r in b.to_pylist()])
        give_back()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(got)], pa.binary())], names=["result"])

    import pickle
    done = rows.repartition(1).mapInArrow(run, "result binary").collect()
    return pickle.loads(done[0][0]) if done else fit([])


def crc32_mod(id_col: str, k: int):
    """crc32 of an id's decimal text, modulo ``k``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % k


def carried(df: DataFrame, id_col: str, text_col: str, carry: list[str]):
    """For an operator that adds columns to rows: ``df`` as ``id``, ``text``,
    ``c0``, ``c1``, ...; the batch columns that hold ``carry``; the schema text of
    what is carried, as ``k0``, ``k1``, ...; and columns that give them their own
    names back. New names, so that no column of ``df`` clashes with the
    operator's; the text travels once."""
    source = ["text" if c == text_col else f"c{i}" for i, c in enumerate(carry)]
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                     *[F.col(c).alias(s) for c, s in zip(carry, source, strict=True) if s != "text"])
    kinds = dict(rows.dtypes)
    schema = "".join(f", k{i} {kinds[s]}" for i, s in enumerate(source))
    return rows, source, schema, [F.col(f"k{i}").alias(c) for i, c in enumerate(carry)]
