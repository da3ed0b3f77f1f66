"""DuckDB SQL equivalents of the named queries (the correctness oracle).

Each string runs on DuckDB with the driver's tables registered as views.
The fixture views are spelled out as CTEs in DuckDB's dialect. Money sums
and means are taken over the raw doubles and rounded to 2 places, as the
registered queries round theirs.
"""

from __future__ import annotations

from ..operators.generate import COINS, EXCHANGES
from ..sources.views import CURRENCIES, PAYMENT_FORMATS

TRADES = """trades AS (
  SELECT event_id AS trade_id,
         CASE WHEN event_id % 211 = 0 THEN NULL ELSE event_type END AS exchange,
         user_id AS trader_id,
         CASE WHEN event_id % 137 = 0 THEN NULL
              ELSE CAST(CAST(value AS DECIMAL(18,2)) * 1000 AS DOUBLE) END AS amount_usd,
         ts AS event_time
  FROM events)"""

CLEAN = """clean AS (
  SELECT *, amount_usd > 100000 AS is_whale_trade FROM trades
  WHERE amount_usd IS NOT NULL AND NOT isnan(amount_usd) AND exchange IS NOT NULL)"""

TRADERS = """traders AS (
  SELECT c_custkey AS trader_id, c_name AS trader_name, c_mktsegment AS risk_level
  FROM customer WHERE c_custkey IN (1, 5, 10, 20, 50))"""

ALL_TRADERS = """all_traders AS (
  SELECT c_custkey AS trader_id, c_name AS trader_name, c_mktsegment AS risk_level FROM customer)"""

TRANSACTIONS = """transactions AS (
  SELECT strftime(l_shipdate + to_minutes(
           CAST((l_orderkey * 37 + l_linenumber * 101) % 1440 AS INT)), '%Y/%m/%d %H:%M') AS ts,
         CAST(l_suppkey AS INT) AS from_bank,
         concat('A', CAST(l_partkey AS VARCHAR)) AS from_account,
         CAST(l_orderkey % 50 AS INT) AS to_bank,
         concat('B', CAST(l_orderkey AS VARCHAR)) AS to_account,
         CASE WHEN l_orderkey % 997 = 0 THEN NULL ELSE l_extendedprice END AS amount_received,
         CASE l_partkey % 6 WHEN 0 THEN 'US Dollar' WHEN 1 THEN 'Euro' WHEN 2 THEN 'Yuan'
              WHEN 3 THEN 'Ruble' WHEN 4 THEN 'Yen' ELSE 'UK Pound' END AS receiving_currency,
         l_extendedprice AS amount_paid,
         CASE l_suppkey % 6 WHEN 0 THEN 'US Dollar' WHEN 1 THEN 'Euro' WHEN 2 THEN 'Yuan'
              WHEN 3 THEN 'Ruble' WHEN 4 THEN 'Yen' ELSE 'UK Pound' END AS payment_currency,
         CASE l_linenumber % 5 WHEN 0 THEN 'Reinvestment' WHEN 1 THEN 'Cheque'
              WHEN 2 THEN 'Credit Card' WHEN 3 THEN 'ACH' ELSE 'Wire' END AS payment_format,
         CASE WHEN (l_orderkey * 7 + l_linenumber) % 1000 = 0 THEN 1 ELSE 0 END AS is_laundering_flag
  FROM lineitem)"""

ENRICHED = """enriched AS (
  SELECT *,
         CASE WHEN amount_received > 10000 THEN 'HIGH'
              WHEN amount_received > 1000 THEN 'MEDIUM' ELSE 'LOW' END AS amount_category,
         try_strptime(ts, '%Y/%m/%d %H:%M') AS event_timestamp,
         CAST(hour(try_strptime(ts, '%Y/%m/%d %H:%M')) AS INT) AS hour_of_day,
         CAST(dayofweek(try_strptime(ts, '%Y/%m/%d %H:%M')) + 1 AS INT) AS day_of_week,
         CASE WHEN is_laundering_flag = 1 THEN 'Yes' ELSE 'No' END AS is_laundering
  FROM transactions)"""


def money_sum(c: str) -> str:
    return f"ROUND(SUM({c}), 2)"


def money_avg(c: str) -> str:
    return f"ROUND(AVG({c}), 2)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


EXCHANGE_STATS = f"""SELECT exchange, COUNT(*) AS trade_count,
       {money_sum('amount_usd')} AS total_volume,
       {money_avg('amount_usd')} AS avg_trade_size,
       MAX(amount_usd) AS max_trade_size
FROM clean GROUP BY exchange"""

WINDOWS = f"""windows AS (
  SELECT time_bucket(INTERVAL '1 minute', event_time) AS window_start,
         time_bucket(INTERVAL '1 minute', event_time) + INTERVAL '1 minute' AS window_end,
         exchange, COUNT(*) AS trade_count, {money_sum('amount_usd')} AS total_volume
  FROM trades WHERE event_time IS NOT NULL
  GROUP BY window_start, window_end, exchange)"""

# -- generators: the same integer arithmetic as operators.generate ----------

M = 2147483647
START_MS = 1785571200000  # 2026-08-01 08:00:00 UTC


def _u(i: str, seed: int, salt: int) -> str:
    x = f"((({i}) + {seed * 1000003 + salt * 7919}) % {M} + {M}) % {M}"
    h1 = f"(({x}) * 48271 + 11) % {M}"
    h2 = f"(({h1}) * ({h1}) + ({x})) % {M}"
    return f"(({h2}) * 69621 + ({h1})) % {M}"


def _between(i, seed, salt, lo, hi):
    return f"({lo} + {_u(i, seed, salt)} % {hi - lo + 1})"


def _cents(i, seed, salt, lo, hi):
    return f"(CAST({_between(i, seed, salt, round(lo * 100), round(hi * 100))} AS DOUBLE) / CAST(100 AS DOUBLE))"


def _choose(i, seed, salt, values):
    lst = "[" + ", ".join(f"'{v}'" for v in values) + "]"
    return f"({lst})[{_u(i, seed, salt)} % {len(values)} + 1]"


EXCH, COINS, CURR, FMTS = EXCHANGES, COINS, CURRENCIES, PAYMENT_FORMATS

GEN_TRADES = f"""SELECT printf('TRD%06d', id) AS trade_id,
  CASE WHEN id % 211 = 0 THEN NULL ELSE {_choose('id', 42, 1, EXCH)} END AS exchange,
  {_choose('id', 42, 2, COINS)} AS coin,
  printf('TRADER%04d', {_between('id', 42, 3, 1, 300)}) AS trader_id,
  CASE WHEN id % 137 = 0 THEN NULL
       WHEN {_u('id', 42, 4)} % 2 = 0 THEN {_cents('id', 42, 5, 50, 5000)}
       ELSE {_cents('id', 42, 6, 100000, 500000)} END AS amount_usd,
  strftime(epoch_ms({START_MS} + {_between('id', 42, 7, 0, 21600)} * 1000), '%Y-%m-%dT%H:%M:%S') AS event_time
FROM (SELECT event_id AS id FROM events)"""

GEN_STREAM_TRADES = f"""SELECT printf('STRD%06d', id) AS trade_id,
  {_choose('id', 7, 1, EXCH)} AS exchange,
  {_choose('id', 7, 2, COINS)} AS coin,
  printf('TRADER%04d', {_between('id', 7, 3, 1, 100)}) AS trader_id,
  {_cents('id', 7, 5, 50, 50000)} AS amount_usd,
  strftime(epoch_ms({START_MS} + id * 500), '%Y-%m-%dT%H:%M:%S.%f') AS event_time
FROM (SELECT event_id AS id FROM events)"""

SYNTHETIC = f"""synthetic AS (SELECT
  strftime(epoch_ms({START_MS} + id * 500), '%Y/%m/%d %H:%M') AS ts,
  CAST({_between('id', 11, 1, 1, 49999)} AS INT) AS from_bank,
  printf('%07X', {_between('id', 11, 3, 1000000, 9999999)}) AS from_account,
  CAST({_between('id', 11, 2, 1, 49999)} AS INT) AS to_bank,
  printf('%07X', {_between('id', 11, 4, 1000000, 9999999)}) AS to_account,
  {_cents('id', 11, 5, 1, 50000)} AS amount_received,
  {_choose('id', 11, 6, CURR)} AS receiving_currency,
  {_cents('id', 11, 5, 1, 50000)} AS amount_paid,
  {_choose('id', 11, 7, CURR)} AS payment_currency,
  {_choose('id', 11, 8, FMTS)} AS payment_format,
  CASE WHEN {_u('id', 11, 9)} % 1000000 < 1000 THEN 1 ELSE 0 END AS is_laundering_flag
FROM (SELECT o_orderkey AS id FROM orders))"""

PROFILED = f"""banks AS (
  SELECT from_bank AS bank, row_number() OVER (ORDER BY cnt DESC, from_bank) - 1 AS idx
  FROM (SELECT from_bank, COUNT(*) AS cnt FROM transactions WHERE from_bank IS NOT NULL
        GROUP BY from_bank ORDER BY cnt DESC, from_bank LIMIT 1000)),
cur AS (
  SELECT receiving_currency AS v, row_number() OVER (ORDER BY COUNT(*) DESC, receiving_currency) - 1 AS idx
  FROM transactions WHERE receiving_currency IS NOT NULL GROUP BY receiving_currency),
fmt AS (
  SELECT payment_format AS v, row_number() OVER (ORDER BY COUNT(*) DESC, payment_format) - 1 AS idx
  FROM transactions WHERE payment_format IS NOT NULL GROUP BY payment_format),
params AS (
  SELECT (SELECT COUNT(*) FROM banks) AS nb, (SELECT COUNT(*) FROM cur) AS nc,
         (SELECT COUNT(*) FROM fmt) AS nf,
         (SELECT AVG(CAST(is_laundering_flag AS DOUBLE)) FROM transactions) AS rate,
         (SELECT MAX(try_strptime(ts, '%Y/%m/%d %H:%M')) FROM transactions) AS as_of)
SELECT id,
  strftime(p.as_of - to_minutes(CAST({_between('id', 13, 10, 0, 60)} AS INT)), '%Y/%m/%d %H:%M') AS ts,
  CAST(fb.bank AS INT) AS from_bank,
  printf('%07X', {_between('id', 13, 3, 1000000, 9999999)}) AS from_account,
  CAST(tb.bank AS INT) AS to_bank,
  printf('%07X', {_between('id', 13, 4, 1000000, 9999999)}) AS to_account,
  {_cents('id', 13, 5, 5, 50000)} AS amount_received,
  rc.v AS receiving_currency,
  {_cents('id', 13, 5, 5, 50000)} AS amount_paid,
  pc.v AS payment_currency,
  pf.v AS payment_format,
  CASE WHEN CAST({_u('id', 13, 9)} AS DOUBLE) < p.rate * CAST({M} AS DOUBLE) THEN 1 ELSE 0 END AS is_laundering_flag
FROM (SELECT o_orderkey AS id FROM orders) ids CROSS JOIN params p
LEFT JOIN banks fb ON fb.idx = {_u('id', 13, 1)} % p.nb
LEFT JOIN banks tb ON tb.idx = {_u('id', 13, 2)} % p.nb
LEFT JOIN cur rc ON rc.idx = {_u('id', 13, 6)} % p.nc
LEFT JOIN cur pc ON pc.idx = {_u('id', 13, 7)} % p.nc
LEFT JOIN fmt pf ON pf.idx = {_u('id', 13, 8)} % p.nf"""

# Names and types of the enriched transactions, in order.
ENRICHED_TYPES = [
    ("ts", "string"), ("from_bank", "int"), ("from_account", "string"), ("to_bank", "int"), ("to_account", "string"),
    ("amount_received", "double"), ("receiving_currency", "string"), ("amount_paid", "double"), ("payment_currency", "string"),
    ("payment_format", "string"), ("is_laundering_flag", "int"), ("amount_category", "string"), ("event_timestamp", "timestamp"),
    ("hour_of_day", "int"), ("day_of_week", "int"), ("is_laundering", "string")]

SCHEMA_LISTING = " UNION ALL ".join(
    f"SELECT '{n}' AS name, '{k}' AS type, COUNT({n}) AS filled FROM enriched" for n, k in ENRICHED_TYPES)

ORACLE_SQL: dict[str, str] = {
    "parquet_scan": with_(TRADES) + "SELECT * FROM trades",
    "csv_scan": with_(TRADES) + """SELECT CAST(trade_id AS VARCHAR) AS trade_id, exchange,
       CAST(trader_id AS VARCHAR) AS trader_id, amount_usd,
       strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') AS event_time FROM trades""",
    "range_count": """SELECT COUNT(*) AS row_count, CAST(COUNT(*) * (COUNT(*) - 1) // 2 AS BIGINT) AS id_sum
FROM events""",
    "whale_trades": with_(TRADES) + "SELECT trade_id, exchange, amount_usd FROM trades WHERE amount_usd > 100000",
    "null_counts": with_(TRADES) + """SELECT COUNT(*) FILTER (WHERE amount_usd IS NULL) AS null_amount_usd,
       COUNT(*) FILTER (WHERE exchange IS NULL) AS null_exchange FROM trades""",
    "quality_report": with_(TRADES, CLEAN) + """SELECT (SELECT COUNT(*) FROM trades) AS original_rows,
       (SELECT COUNT(*) FROM clean) AS cleaned_rows,
       (SELECT COUNT(*) FROM trades) - (SELECT COUNT(*) FROM clean) AS removed_rows,
       (SELECT COUNT(*) FROM trades WHERE amount_usd IS NULL) AS null_amount_usd,
       (SELECT COUNT(*) FROM trades WHERE exchange IS NULL) AS null_exchange""",
    "clean_trades": with_(TRADES, CLEAN) + "SELECT * FROM clean",
    "filled_trades": with_(TRADES) + """SELECT trade_id, COALESCE(exchange, '') AS exchange, trader_id,
       amount_usd, event_time FROM trades""",
    "head_n": with_(TRADES) + "SELECT * FROM trades ORDER BY trade_id LIMIT 10",
    "exchange_stats": with_(TRADES, CLEAN) + EXCHANGE_STATS,
    "top_exchange": with_(TRADES, CLEAN, f"stats AS ({EXCHANGE_STATS})")
    + "SELECT exchange FROM stats ORDER BY total_volume DESC NULLS LAST, exchange LIMIT 1",
    "trade_summary": with_(TRADES, CLEAN, f"stats AS ({EXCHANGE_STATS})") + """SELECT
       (SELECT COUNT(*) FROM trades) AS total_trades,
       (SELECT COUNT(*) FROM clean) AS cleaned_trades,
       (SELECT COUNT(*) FROM trades WHERE amount_usd > 100000) AS whale_trades,
       (SELECT exchange FROM stats ORDER BY total_volume DESC, exchange LIMIT 1) AS top_exchange""",
    "trade_count": with_(TRADES) + "SELECT COUNT(*) AS row_count FROM trades",
    "trader_join": with_(TRADES, CLEAN, TRADERS) + """SELECT c.*, l.trader_name, l.risk_level
FROM clean c LEFT JOIN traders l ON c.trader_id = l.trader_id""",
    "unmatched_trades": with_(TRADES, CLEAN, TRADERS) + """SELECT trade_id, trader_id, amount_usd FROM clean c
WHERE NOT EXISTS (SELECT 1 FROM traders l WHERE l.trader_id = c.trader_id)""",
    "trader_join_full": with_(TRADES, CLEAN, ALL_TRADERS) + """SELECT c.*, l.trader_name, l.risk_level
FROM clean c LEFT JOIN all_traders l ON c.trader_id = l.trader_id""",
    "enriched_transactions": with_(TRANSACTIONS, ENRICHED) + "SELECT * FROM enriched",
    "laundering_counts": with_(TRANSACTIONS, ENRICHED)
    + "SELECT is_laundering, COUNT(*) AS count FROM enriched GROUP BY is_laundering",
    "laundering_share": with_(TRANSACTIONS, ENRICHED) + """SELECT is_laundering, COUNT(*) AS count,
       CAST(COUNT(*) AS DOUBLE) * 100.0 / (SELECT COUNT(*) FROM enriched) AS pct
FROM enriched GROUP BY is_laundering""",
    "tier_stats": with_(TRANSACTIONS, ENRICHED) + f"""SELECT amount_category, COUNT(*) AS count,
       {money_avg('amount_received')} AS avg_amount, {money_sum('amount_received')} AS total_amount
FROM enriched GROUP BY amount_category""",
    "weekday_stats": with_(TRANSACTIONS, ENRICHED) + f"""SELECT day_of_week, COUNT(*) AS count,
       {money_sum('amount_received')} AS total_amount
FROM enriched GROUP BY day_of_week ORDER BY day_of_week NULLS FIRST""",
    "hour_stats": with_(TRANSACTIONS, ENRICHED) + """SELECT hour_of_day, COUNT(*) AS count
FROM enriched GROUP BY hour_of_day ORDER BY hour_of_day NULLS FIRST""",
    "amount_describe": with_(TRANSACTIONS, ENRICHED) + """SELECT COUNT(amount_received) AS count,
       ROUND(AVG(amount_received), 4) AS mean, ROUND(STDDEV_SAMP(amount_received), 4) AS stddev,
       MIN(amount_received) AS min, MAX(amount_received) AS max FROM enriched""",
    "transaction_count": with_(TRANSACTIONS) + "SELECT COUNT(*) AS row_count FROM transactions",
    "bank_profile": with_(TRANSACTIONS) + """SELECT from_bank, COUNT(*) AS count FROM transactions
WHERE from_bank IS NOT NULL GROUP BY from_bank ORDER BY count DESC, from_bank LIMIT 1000""",
    "currency_profile": with_(TRANSACTIONS) + """SELECT receiving_currency, COUNT(*) AS count FROM transactions
WHERE receiving_currency IS NOT NULL GROUP BY receiving_currency ORDER BY count DESC, receiving_currency""",
    "format_profile": with_(TRANSACTIONS) + """SELECT payment_format, COUNT(*) AS count FROM transactions
WHERE payment_format IS NOT NULL GROUP BY payment_format ORDER BY count DESC, payment_format""",
    "label_rate": with_(TRANSACTIONS)
    + "SELECT AVG(CAST(is_laundering_flag AS DOUBLE)) AS label_rate FROM transactions",
    "laundering_tally": with_(TRANSACTIONS) + """SELECT COUNT(*) AS sent,
       COUNT(*) FILTER (WHERE is_laundering_flag = 1) AS flagged,
       CAST(COUNT(*) FILTER (WHERE is_laundering_flag = 1) AS DOUBLE) * 100.0 / NULLIF(COUNT(*), 0) AS flagged_pct
FROM transactions""",
    "decoded_messages": with_(TRANSACTIONS)
    + "SELECT COALESCE(CAST(from_bank AS VARCHAR), 'unknown') AS key, *, TRUE AS stamped FROM transactions",
    "decode_losses": with_(TRANSACTIONS)
    + "SELECT COUNT(*) AS messages, COUNT(*) FILTER (WHERE from_bank % 5 = 0) AS undecoded FROM transactions",
    "formatted_transactions": with_(TRANSACTIONS, ENRICHED) + """SELECT ts, strftime(event_timestamp, '%Y/%m/%d %H:%M') AS formatted,
       printf('%07X', from_bank) AS bank_hex, printf('BANK%04d', to_bank) AS bank_padded,
       ROUND(amount_received, 0) AS amount_rounded, TRUE AS processed FROM enriched""",
    "schema_listing": with_(TRANSACTIONS, ENRICHED) + SCHEMA_LISTING,
    "large_lines": "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_extendedprice > 50000",
    "top_banks": with_(TRANSACTIONS) + """SELECT from_bank, COUNT(*) AS count FROM transactions
WHERE from_bank IS NOT NULL GROUP BY from_bank ORDER BY count DESC, from_bank LIMIT 5""",
    "inline_lookup_join": with_(TRADES, CLEAN) + """SELECT c.*, CASE WHEN c.trader_id IN (1, 5, 10, 20, 50)
       THEN 'trader ' || c.trader_id END AS trader_name FROM clean c""",
    "unmatched_trades_full": with_(TRADES, CLEAN, ALL_TRADERS) + """SELECT trade_id, trader_id, amount_usd FROM clean c
WHERE NOT EXISTS (SELECT 1 FROM all_traders l WHERE l.trader_id % 3 <> 0 AND l.trader_id = c.trader_id)""",
    "trade_messages": with_(TRADES) + "SELECT CAST(NULL AS VARCHAR) AS key, * FROM trades",
    "replay_cycles": with_(TRADES)
    + "SELECT CAST(r.range AS INTEGER) AS cycle, t.* FROM range(1, 4) r CROSS JOIN trades t",
    "parquet_roundtrip": with_(TRADES, CLEAN, f"stats AS ({EXCHANGE_STATS})")
    + "SELECT *, (SELECT COUNT(*) FROM stats) AS written_rows FROM stats",
    "partitioned_enriched": with_(TRANSACTIONS, ENRICHED) + "SELECT * FROM enriched",
    "windowed_trades_batch": with_(TRADES, WINDOWS) + "SELECT * FROM windows",
    "windowed_trades_stream": with_(TRADES, WINDOWS) + "SELECT * FROM windows",
    "windowed_trades_complete": with_(TRADES, WINDOWS) + "SELECT * FROM windows",
    "windowed_trades_append": with_(TRADES, WINDOWS) + """SELECT * FROM windows
WHERE window_end <= (SELECT MAX(event_time) FROM trades) - INTERVAL '2 minutes'""",
    "stream_enrich_sink": with_(TRANSACTIONS, ENRICHED) + "SELECT * FROM enriched",
    "stream_enrich_batches": with_(TRANSACTIONS, ENRICHED) + "SELECT * FROM enriched",
    "generated_trades": GEN_TRADES,
    "generated_stream_trades": GEN_STREAM_TRADES,
    "synthetic_transactions": with_(SYNTHETIC) + "SELECT * FROM synthetic",
    "synthetic_tally": with_(SYNTHETIC) + """SELECT COUNT(*) AS sent,
       COUNT(*) FILTER (WHERE is_laundering_flag = 1) AS flagged,
       CAST(COUNT(*) FILTER (WHERE is_laundering_flag = 1) AS DOUBLE) * 100.0 / NULLIF(COUNT(*), 0) AS flagged_pct
FROM synthetic""",
    "profiled_transactions": with_(TRANSACTIONS, PROFILED),
    "transactions_csv_scan": with_(TRANSACTIONS, ENRICHED) + "SELECT * FROM enriched",
    "stream_summary": with_(TRANSACTIONS, ENRICHED) + f"""SELECT day_of_week, amount_category, COUNT(*) AS count,
       {money_sum('amount_received')} AS total_amount FROM enriched GROUP BY day_of_week, amount_category""",
    "generated_trade_windows": f"""WITH g AS ({GEN_STREAM_TRADES}),
t AS (SELECT CAST(event_time AS TIMESTAMP) AS ts, exchange, amount_usd FROM g)
SELECT time_bucket(INTERVAL '1 minute', ts) AS window_start,
       time_bucket(INTERVAL '1 minute', ts) + INTERVAL '1 minute' AS window_end,
       exchange, COUNT(*) AS trade_count, {money_sum('amount_usd')} AS total_volume
FROM t GROUP BY window_start, window_end, exchange""",
}
