"""Lookup join and unmatched rows.

Spark picks the join from the sides' bytes: at run time AQE broadcasts a
lookup below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles
both sides, splitting a hot key (one trader with a third of all trades) on the
streamed side. Nothing is counted or scanned while the plan is built. Two
requests a caller can make:

* ``broadcast=True`` for a lookup made from a driver-side list, whose size the
  caller knows;
* ``salt_buckets`` where the hot key exceeds what AQE splits well: the big
  side gets a salt in ``[0, salt_buckets)`` from a hash of its own columns, the
  lookup is replicated once per salt value, and the join key becomes (key,
  salt). Each left row still meets exactly one copy of its lookup rows, so the
  result is unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SALT = "__salt"


def _salted(left: DataFrame, lookup: DataFrame, key: str, buckets: int):
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(buckets))
    left_s = left.withColumn(_SALT, salt)
    lookup_s = lookup.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return left_s, lookup_s


def lookup_join(df: DataFrame, lookup: DataFrame, key: str = "trader_id", how: str = "left",
                broadcast: bool = False, salt_buckets: int | None = None) -> DataFrame:
    """``df`` joined to ``lookup`` on ``key`` (one key column in the output)."""
    if broadcast:
        return df.join(F.broadcast(lookup), on=key, how=how)
    if salt_buckets and salt_buckets > 1 and how in ("left", "left_outer", "inner", "left_anti", "left_semi"):
        left_s, lookup_s = _salted(df, lookup, key, salt_buckets)
        return left_s.join(lookup_s, on=[key, _SALT], how=how).drop(_SALT)
    return df.join(lookup, on=key, how=how)


def unmatched(df: DataFrame, lookup: DataFrame, key: str = "trader_id",
              columns: list[str] | None = None, broadcast: bool = False,
              salt_buckets: int | None = None) -> DataFrame:
    """Rows of ``df`` with no lookup row for their key (a null key never
    matches). An anti join -- a matched row with a null name is not
    "unmatched" (D13)."""
    keys = lookup.select(key)
    out = lookup_join(df, keys, key=key, how="left_anti", broadcast=broadcast, salt_buckets=salt_buckets)
    return out.select(*columns) if columns else out
