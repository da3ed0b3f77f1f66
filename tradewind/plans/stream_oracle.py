"""DuckDB SQL of ``plans.stream_queries``. The lateness rules are spelled from
first principles: which batch a row arrives in, and how far the watermark has
come by then."""

from __future__ import annotations

from .oracle import ENRICHED, TRADES, TRANSACTIONS, WINDOWS, money_sum, with_
from .stream_queries import (BATCHES, DIMS, LATE_DAYS, LOST_BLOCK, LOST_EVERY, OUT_OF_ORDER, PERCENTILES, SETS,
                             TOPIC_PARTITIONS, VERSION_DAYS, VERSIONS)

_DELAY = " ".join(f"WHEN trade_id % 50 = {rest} THEN INTERVAL {days} DAY" for rest, days in reversed(LATE_DAYS))

# A batch finds windows closed by the watermark of the batch before it, which
# rests on the rows up to two batches back.
LATENESS = f"""arrived AS (
  SELECT *, event_time + CASE {_DELAY} WHEN trade_id % 20 = {OUT_OF_ORDER[0]} THEN INTERVAL {OUT_OF_ORDER[1]} SECOND
                              ELSE INTERVAL 0 SECOND END AS arrival FROM trades),
batched AS (
  SELECT *, (row_number() OVER (ORDER BY arrival, trade_id) - 1) // ((count(*) OVER () + {BATCHES - 1}) // {BATCHES}) AS batch FROM arrived),
marks AS (
  SELECT batch, max(max(event_time)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - INTERVAL 2 MINUTE AS mark
  FROM batched GROUP BY batch),
lateness AS (
  SELECT time_bucket(INTERVAL '1 minute', event_time) AS window_start, time_bucket(INTERVAL '1 minute', event_time) + INTERVAL '1 minute' AS window_end,
         exchange, amount_usd, mark IS NULL OR time_bucket(INTERVAL '1 minute', event_time) + INTERVAL '1 minute' > mark AS kept
  FROM batched JOIN marks USING (batch))"""

_BY_WINDOW = "GROUP BY window_start, window_end, exchange"

SESSIONS = """stepped AS (
  SELECT trader_id, event_time, amount_usd,
         CASE WHEN event_time - lag(event_time) OVER w <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens
  FROM trades WINDOW w AS (PARTITION BY trader_id ORDER BY event_time)),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY trader_id ORDER BY event_time ROWS UNBOUNDED PRECEDING) AS nth FROM stepped)"""

VERSION_ROWS = f"""versions AS (
  SELECT c_custkey AS trader_id, CAST(v AS INT) AS version,
         TIMESTAMP '2023-12-24' + to_hours(CAST(v * {24 * VERSION_DAYS} + (c_custkey * 7 + v * 13) % 48 AS INT)) AS valid_from,
         ['LOW', 'MEDIUM', 'HIGH'][(c_custkey + v) % 3 + 1] AS risk_level
  FROM customer, range({VERSIONS}) r(v))"""

_SETS = ", ".join(f"({', '.join(s)})" for s in SETS)

STREAM_ORACLE_SQL: dict[str, str] = {
    "late_windows": with_(TRADES, LATENESS) + f"""SELECT window_start, window_end, exchange, COUNT(*) FILTER (kept) AS trade_count,
       ROUND(SUM(amount_usd) FILTER (kept), 2) AS total_volume, COUNT(*) AS arrived, COUNT(*) FILTER (NOT kept) AS dropped
FROM lateness {_BY_WINDOW}""",
    "restarted_windows": with_(TRADES, LATENESS) + f"""SELECT window_start, window_end, exchange, COUNT(*) AS trade_count,
       {money_sum('amount_usd')} AS total_volume FROM lateness WHERE kept {_BY_WINDOW}""",
    "distinct_trades": with_(TRADES) + "SELECT * FROM trades",
    "committed_transactions": with_(TRANSACTIONS, ENRICHED) + "SELECT * FROM enriched",
    "window_snapshot": with_(TRADES, WINDOWS) + "SELECT * FROM windows",
    "lost_offsets": with_(TRADES) + f"""SELECT p AS partition, o + 1 AS first_lost, nxt - 1 AS last_lost, nxt - o - 1 AS lost
FROM (SELECT p, o, lead(o) OVER (PARTITION BY p ORDER BY o) AS nxt
      FROM (SELECT trade_id % {TOPIC_PARTITIONS} AS p, trade_id // {TOPIC_PARTITIONS} AS o FROM trades)
      WHERE (o // {LOST_BLOCK}) % {LOST_EVERY} <> 3)
WHERE nxt > o + 1""",
    "trader_sessions": with_(TRADES, SESSIONS) + f"""SELECT trader_id, min(event_time) AS session_start, max(event_time) + INTERVAL 6 HOUR AS session_end,
       COUNT(*) AS trade_count, {money_sum('amount_usd')} AS total_volume
FROM numbered GROUP BY trader_id, nth
HAVING max(event_time) + INTERVAL 6 HOUR <= (SELECT max(event_time) FROM trades) - INTERVAL 2 MINUTE""",
    "versioned_traders": with_(TRADES, VERSION_ROWS) + """SELECT trade_id, t.trader_id, amount_usd, version, risk_level
FROM trades t ASOF JOIN versions v ON t.trader_id = v.trader_id AND t.event_time >= v.valid_from""",
    "transaction_subtotals": with_(TRANSACTIONS, ENRICHED) + f"""SELECT {', '.join(DIMS)}, CAST(GROUPING({', '.join(DIMS)}) AS BIGINT) AS grouping_id,
       COUNT(*) AS count, {money_sum('amount_received')} AS total_amount
FROM enriched GROUP BY GROUPING SETS ({_SETS})""",
    "tier_percentiles": with_(TRANSACTIONS, ENRICHED) + f"""SELECT amount_category, prob, value FROM (
  SELECT amount_category, unnest({PERCENTILES}::DOUBLE[]) AS prob, unnest(quantile_disc(amount_received, {PERCENTILES})) AS value
  FROM enriched WHERE amount_received IS NOT NULL GROUP BY amount_category)""",
    "heavy_banks": with_(TRANSACTIONS) + """SELECT from_bank, COUNT(*) AS count FROM transactions WHERE from_bank IS NOT NULL
GROUP BY from_bank ORDER BY count DESC, from_bank LIMIT 1000""",
    "verified_transactions": with_(TRANSACTIONS) + "SELECT * FROM transactions",
}
