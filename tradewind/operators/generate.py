"""Seeded data generators.

Every value is a pure function of (seed, row id, field salt), computed with
64-bit integer arithmetic -- no ``rand()``, whose stream depends on how rows
are split into partitions. The same rows come out on 1 or 1000 tasks, on a
retried task, and (the arithmetic being plain SQL) in any other SQL engine.
Ids come from a caller's frame (e.g. a table's key column) or ``spark.range``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import hex_id, padded_id
from ..session import ensure_checkpoint_dir
from ..sources.views import CURRENCIES, PAYMENT_FORMATS

MODULUS = 2147483647          # 2^31 - 1; every product below stays under 2^63
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TXN_TIME = "yyyy/MM/dd HH:mm"

# Fixed value domains of the reference's generators.
EXCHANGES = ["BINANCE", "COINBASE", "KRAKEN", "BYBIT", "OKX"]
COINS = ["BTC", "ETH", "SOL", "XRP", "DOGE"]
SAMPLE_START = "2026-08-01 08:00:00"
SAMPLE_SPAN_SECONDS = 6 * 3600
SAMPLE_NULL_AMOUNT_EVERY = 137
SAMPLE_NULL_EXCHANGE_EVERY = 211


def is_small(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows: ``take`` stops as soon
    as one more is found."""
    return len(df.select(F.lit(1).alias("one")).take(max_rows + 1)) <= max_rows


def uniform_int(ids: Column, seed: int, salt: int) -> Column:
    """A well-mixed integer in ``[0, MODULUS)`` for each id.

    Two multiplicative rounds around a quadratic one; all intermediate
    values are < 2^62, so bigint arithmetic never overflows.
    """
    m = F.lit(MODULUS)
    x = F.pmod(ids.cast("bigint") + F.lit(seed * 1000003 + salt * 7919), m)
    h1 = (x * F.lit(48271) + F.lit(11)) % m
    h2 = (h1 * h1 + x) % m
    return (h2 * F.lit(69621) + h1) % m


def uniform_between(ids: Column, seed: int, salt: int, lo: int, hi: int) -> Column:
    """Integer in ``[lo, hi]`` (inclusive)."""
    return F.lit(lo) + uniform_int(ids, seed, salt) % F.lit(hi - lo + 1)


def uniform_cents(ids: Column, seed: int, salt: int, lo: float, hi: float) -> Column:
    """Money amount in ``[lo, hi]`` with 2 decimals, exact (integer cents / 100)."""
    return uniform_between(ids, seed, salt, round(lo * 100), round(hi * 100)) / F.lit(100.0)


def choose(ids: Column, seed: int, salt: int, values: Sequence[str]) -> Column:
    """One of ``values``, uniformly."""
    idx = uniform_int(ids, seed, salt) % F.lit(len(values))
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def epoch_ms(start: str) -> int:
    """Milliseconds since the epoch of a UTC ``yyyy-MM-dd HH:mm:ss`` string."""
    from datetime import datetime, timezone
    return int(datetime.strptime(start, "%Y-%m-%d %H:%M:%S").replace(tzinfo=timezone.utc).timestamp() * 1000)


def _at_ms(start: str, ms: Column) -> Column:
    return F.timestamp_millis(F.lit(epoch_ms(start)) + ms)


def sample_trades(ids: DataFrame, id_col: str = "id", seed: int = 42, start: str = SAMPLE_START,
                  span_seconds: int = SAMPLE_SPAN_SECONDS, traders: int = 300) -> DataFrame:
    """G1: batch sample trades -- bimodal amount (U(50,5000) or
    U(100000,500000)), null amount every 137th id, null exchange every 211th."""
    i = F.col(id_col)
    low = uniform_cents(i, seed, 5, 50, 5000)
    high = uniform_cents(i, seed, 6, 100000, 500000)
    amount = F.when(uniform_int(i, seed, 4) % 2 == 0, low).otherwise(high)
    return ids.select(
        padded_id("TRD", i, 6).alias("trade_id"),
        F.when(i % SAMPLE_NULL_EXCHANGE_EVERY == 0, F.lit(None).cast("string"))
         .otherwise(choose(i, seed, 1, EXCHANGES)).alias("exchange"),
        choose(i, seed, 2, COINS).alias("coin"),
        padded_id("TRADER", uniform_between(i, seed, 3, 1, traders), 4).alias("trader_id"),
        F.when(i % SAMPLE_NULL_AMOUNT_EVERY == 0, F.lit(None).cast("double"))
         .otherwise(amount).alias("amount_usd"),
        F.date_format(_at_ms(start, uniform_between(i, seed, 7, 0, span_seconds) * F.lit(1000)),
                      ISO_SECONDS).alias("event_time"),
    )


def stream_trades(ids: DataFrame, id_col: str = "id", seed: int = 7, start: str = SAMPLE_START,
                  rate_per_second: float = 2.0, traders: int = 100) -> DataFrame:
    """Stream-shaped trades -- ids STRD, trader 1..100, amount
    U(50,50000), no nulls; event time advances at ``rate_per_second``."""
    i = F.col(id_col)
    step_ms = int(round(1000 / rate_per_second))
    return ids.select(
        padded_id("STRD", i, 6).alias("trade_id"),
        choose(i, seed, 1, EXCHANGES).alias("exchange"),
        choose(i, seed, 2, COINS).alias("coin"),
        padded_id("TRADER", uniform_between(i, seed, 3, 1, traders), 4).alias("trader_id"),
        uniform_cents(i, seed, 5, 50, 50000).alias("amount_usd"),
        F.date_format(_at_ms(start, i * F.lit(step_ms)), ISO_MICROS).alias("event_time"),
    )


def synthetic_transactions(ids: DataFrame, id_col: str = "id", seed: int = 11,
                           start: str = SAMPLE_START, rate_per_second: float = 2.0,
                           banks: int = 49999, flag_rate: float = 0.001) -> DataFrame:
    """Fixed-domain transactions -- banks 1..49999, six currencies, five
    formats, amount U(1,50000) received = paid, flag with ``flag_rate``."""
    i = F.col(id_col)
    step_ms = int(round(1000 / rate_per_second))
    amount = uniform_cents(i, seed, 5, 1, 50000)
    return ids.select(
        F.date_format(_at_ms(start, i * F.lit(step_ms)), TXN_TIME).alias("ts"),
        uniform_between(i, seed, 1, 1, banks).cast("int").alias("from_bank"),
        hex_id(uniform_between(i, seed, 3, 1000000, 9999999)).alias("from_account"),
        uniform_between(i, seed, 2, 1, banks).cast("int").alias("to_bank"),
        hex_id(uniform_between(i, seed, 4, 1000000, 9999999)).alias("to_account"),
        amount.alias("amount_received"),
        choose(i, seed, 6, CURRENCIES).alias("receiving_currency"),
        amount.alias("amount_paid"),
        choose(i, seed, 7, CURRENCIES).alias("payment_currency"),
        choose(i, seed, 8, PAYMENT_FORMATS).alias("payment_format"),
        F.when(uniform_int(i, seed, 9) % 1000000 < F.lit(int(round(flag_rate * 1000000))), F.lit(1))
         .otherwise(F.lit(0)).alias("is_laundering_flag"),
    )


# -- profile-driven (G4) ------------------------------------------------------

LOCAL_INDEX_MAX_ROWS = 100_000
_IDX = "idx"


def dense_index(df: DataFrame, order: Sequence[Column], max_local_rows: int = LOCAL_INDEX_MAX_ROWS,
                size: int | None = None) -> DataFrame:
    """Add ``idx`` = 0, 1, 2, ... in ``order`` (a total order over ``df``).

    A list proven small is numbered with one window. A larger one is range
    partitioned, numbered inside each partition, and shifted by the sizes of
    the partitions before it; that offset table has one row per partition
    (a proven bound), so it is the only thing broadcast. The range split is
    checkpointed (reliably, to ``spark.checkpoint.dir``) before it is used
    twice, so both uses see the same partition ids even if a task reruns.
    ``size``, when the caller already knows the row count, skips the check.
    """
    small = size <= max_local_rows if size is not None else is_small(df, max_local_rows)
    if small:
        return df.withColumn(_IDX, F.row_number().over(Window.orderBy(*order)) - 1)
    pid = "__pid"
    ensure_checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(*order).withColumn(pid, F.spark_partition_id()).checkpoint()
    local = ranged.withColumn("__local", F.row_number().over(Window.partitionBy(pid).orderBy(*order)) - 1)
    sizes = ranged.groupBy(pid).agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.withColumn(
        "__offset", F.coalesce(F.sum("__n").over(Window.orderBy(pid).rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0))).select(pid, "__offset")
    return (local.join(F.broadcast(offsets), pid)
            .withColumn(_IDX, F.col("__offset") + F.col("__local"))
            .drop(pid, "__local", "__offset"))


def value_profile(history: DataFrame, columns: dict[str, str], flag_col: str | None = None,
                  time_col: str | None = None, time_format: str = TXN_TIME) -> DataFrame:
    """Value counts of several columns in one scan: (kind, s, n, count, ...).

    Each row is exploded into one (kind, value) pair per column, so a single
    partial + final aggregation covers all columns. ``n`` keeps an integral
    value's number for numeric tie-breaking, ``s`` its text. Nulls are
    excluded, as the reference's value counts do.

    With ``flag_col`` / ``time_col`` every row also yields one ``kind =
    'all'`` pair carrying the 0/1 flag and the parsed time (parsed once per
    row, before the explode), so the label rate (``flag_sum / flag_n``) and
    the latest time (``max_time``) come out of the same scan.
    """
    pairs = []
    for kind, col in columns.items():
        c = F.col(col)
        integral = history.schema[col].dataType.simpleString() in ("int", "bigint", "smallint", "tinyint")
        pairs.append(F.struct(F.lit(kind).alias("kind"), c.cast("string").alias("s"),
                              (c.cast("bigint") if integral else F.lit(None).cast("bigint")).alias("n"),
                              F.lit(None).cast("bigint").alias("flag"), F.lit(None).cast("timestamp").alias("t")))
    base = history
    with_facts = flag_col is not None or time_col is not None
    if with_facts:
        base = history.withColumns({
            "__flag": F.col(flag_col).cast("bigint") if flag_col else F.lit(None).cast("bigint"),
            "__t": F.try_to_timestamp(F.col(time_col), F.lit(time_format)) if time_col
            else F.lit(None).cast("timestamp")})
        pairs.append(F.struct(F.lit("all").alias("kind"), F.lit("").alias("s"), F.lit(None).cast("bigint").alias("n"),
                              F.col("__flag").alias("flag"), F.col("__t").alias("t")))
    exploded = base.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")
    return (exploded.filter(F.col("s").isNotNull()).groupBy("kind", "s", "n")
            .agg(F.count(F.lit(1)).alias("count"), F.sum("flag").alias("flag_sum"),
                 F.count("flag").alias("flag_n"), F.max("t").alias("max_time")))


def _ranked(profile: DataFrame, kind: str, total: int, top_n: int | None) -> tuple[DataFrame, int]:
    """The values of one kind indexed 0.. by frequency (ties by value),
    keeping the ``top_n`` most frequent of ``total``; returns (list, size)."""
    order = [F.col("count").desc(), F.col("n").asc(), F.col("s").asc()]
    vals = profile.filter(F.col("kind") == kind)
    size = total
    if top_n and top_n < total:
        vals, size = vals.orderBy(*order).limit(top_n), top_n
    return dense_index(vals, order, size=size).select(F.col(_IDX), "s", "n"), size


def _pick(rows: DataFrame, ids: Column, seed: int, salt: int, values: DataFrame,
          size: int, out: str) -> DataFrame:
    """Join the value at ``uniform % size`` of an indexed list of ``size``
    rows: broadcast when ``size`` is within the local bound, otherwise a
    shuffle join on the index, whose values are uniform and never skewed.
    An empty list gives null."""
    key = f"__{out}_idx"
    rows = rows.withColumn(key, uniform_int(ids, seed, salt) % F.lit(max(size, 1)))
    v = values.withColumnRenamed(_IDX, key).withColumnRenamed(values.columns[-1], out)
    small = size <= LOCAL_INDEX_MAX_ROWS
    return rows.join(F.broadcast(v) if small else v, key, "left").drop(key)


def profiled_transactions(ids: DataFrame, history: DataFrame, id_col: str = "id", seed: int = 13,
                          as_of: Column | None = None, top_banks: int = 1000,
                          minutes_back: int = 60) -> DataFrame:
    """Transactions drawn from a history table's profile.

    Banks uniformly from the ``top_banks`` most frequent senders (sender and
    receiver independent, may be equal), currencies and formats uniformly
    from the distinct observed values (nulls excluded), amount U(5,50000)
    with received = paid, the label with the observed rate, and a time in
    the ``minutes_back`` minutes before ``as_of`` (default: the history's
    latest timestamp, a scalar subquery).
    """
    i = F.col(id_col)
    # One scan of the history for all three value lists; the profile is
    # small (distinct values only), so it is checkpointed to the shared
    # folder and every later use -- size checks, indexing, joins -- reads
    # that instead of rescanning the history.
    ensure_checkpoint_dir(history.sparkSession)
    profile = value_profile(history, {"bank": "from_bank", "currency": "receiving_currency",
                                      "format": "payment_format"},
                            flag_col="is_laundering_flag", time_col="ts").checkpoint()
    # The three list sizes in one small job over the checkpointed profile.
    sizes = profile.agg(*[F.count_if(F.col("kind") == k).alias(k)
                          for k in ("bank", "currency", "format")]).first()
    banks, n_banks = _ranked(profile, "bank", sizes["bank"], top_banks)
    currencies, n_cur = _ranked(profile, "currency", sizes["currency"], None)
    formats, n_fmt = _ranked(profile, "format", sizes["format"], None)
    banks = banks.select(_IDX, F.col("n").cast("int").alias("bank"))
    currencies = currencies.select(_IDX, F.col("s").alias("currency"))
    formats = formats.select(_IDX, F.col("s").alias("fmt"))
    # Label rate and latest time from the profile's 'all' row: one scalar
    # subquery over the small checkpointed table, no further history scan.
    facts = profile.filter(F.col("kind") == "all").agg(F.struct(
        (F.sum("flag_sum").cast("double") / F.sum("flag_n")).alias("rate"),
        F.max("max_time").alias("as_of"))).scalar()
    rate = facts.getField("rate")
    if as_of is None:
        as_of = facts.getField("as_of")

    rows = ids.select(i)
    rows = _pick(rows, i, seed, 1, banks, n_banks, "from_bank")
    rows = _pick(rows, i, seed, 2, banks, n_banks, "to_bank")
    rows = _pick(rows, i, seed, 6, currencies, n_cur, "receiving_currency")
    rows = _pick(rows, i, seed, 7, currencies, n_cur, "payment_currency")
    rows = _pick(rows, i, seed, 8, formats, n_fmt, "payment_format")
    amount = uniform_cents(i, seed, 5, 5, 50000)
    minutes = uniform_between(i, seed, 10, 0, minutes_back)
    flagged = uniform_int(i, seed, 9).cast("double") < rate * F.lit(float(MODULUS))
    return rows.select(
        i.alias(id_col),
        F.date_format(as_of - F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"), F.lit(0)),
                      TXN_TIME).alias("ts"),
        F.col("from_bank").cast("int").alias("from_bank"),
        hex_id(uniform_between(i, seed, 3, 1000000, 9999999)).alias("from_account"),
        F.col("to_bank").cast("int").alias("to_bank"),
        hex_id(uniform_between(i, seed, 4, 1000000, 9999999)).alias("to_account"),
        amount.alias("amount_received"),
        "receiving_currency",
        amount.alias("amount_paid"),
        "payment_currency",
        "payment_format",
        F.when(flagged, F.lit(1)).otherwise(F.lit(0)).alias("is_laundering_flag"),
    )
