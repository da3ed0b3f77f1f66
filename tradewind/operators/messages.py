"""Message encoding and replay (M1, M2, M3; X11, X12, X17).

The feeders' data work -- turning rows into keyed JSON messages -- as one
narrow projection. Delivery to Kafka is ``sinks.kafka.write_kafka``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import ingest_stamp, message_key
from ..schemas import TRANSACTION_RAW_NAMES

# JSON text of timestamps: ISO-8601 with microseconds, so an encode/decode
# round trip keeps every digit (Spark's default writes milliseconds).
JSON_WRITE_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def encode_messages(df: DataFrame, key_col: str | None = None,
                    stamp_col: str | None = None, beside: Sequence[str] = ()) -> DataFrame:
    """Rows -> (key string, value JSON string, and the columns ``beside``, which
    are not part of the JSON).

    ``key_col`` gives the key as a string ("unknown" when missing); without
    it the key is null. ``stamp_col`` adds an ISO ingest stamp to the JSON.
    ``to_json`` leaves null fields out; decoding restores them as null.
    """
    cols = [F.col(f"`{c}`") for c in df.columns if c not in beside]
    if stamp_col:
        cols.append(ingest_stamp().alias(stamp_col))
    key = message_key(key_col) if key_col else F.lit(None).cast("string")
    return df.select(key.alias("key"), F.to_json(F.struct(*cols), JSON_WRITE_OPTIONS).alias("value"), *beside)


def encode_transactions(df: DataFrame, key_col: str = "from_bank",
                        stamp_col: str = "kafka_timestamp") -> DataFrame:
    """M1: key = sender bank as string; value = JSON of the row + ingest stamp,
    under the wire's names (``Timestamp``, ``From Bank``, ``Account.1``, ...)."""
    wire = {name: raw for raw, name in TRANSACTION_RAW_NAMES.items()}
    raw = df.toDF(*[wire.get(c, c) for c in df.columns])
    return encode_messages(raw, key_col=f"`{wire.get(key_col, key_col)}`", stamp_col=stamp_col)


def encode_trades(df: DataFrame) -> DataFrame:
    """M2: unkeyed JSON trades."""
    return encode_messages(df, key_col=None, stamp_col=None)


def replay_cycles(df: DataFrame, cycles: int, cycle_col: str = "cycle") -> DataFrame:
    """M3: the whole table repeated ``cycles`` times, cycle numbered from 1.

    A generator (``explode(sequence)``) on each row: narrow, no join, no
    shuffle; output partitions grow with ``cycles``.
    """
    return df.select(F.explode(F.sequence(F.lit(1), F.lit(cycles))).alias(cycle_col), "*")
