from pyspark.sql import functions as F

from tradewind import functions as X


def test_amount_tier_edges(spark):
    rows = [(None,), (float("nan"),), (10000.0,), (10000.01,), (1000.0,), (1000.01,), (-5.0,)]
    df = spark.createDataFrame(rows, "a double").coalesce(1)
    got = [r[0] for r in df.select(X.amount_tier("a")).collect()]
    assert got == ["LOW", "HIGH", "MEDIUM", "HIGH", "LOW", "MEDIUM", "LOW"]
    normalized = [r[0] for r in df.select(X.amount_tier(X.nan_to_null("a"))).collect()]
    assert normalized[1] == "LOW"


def test_laundering_flag(spark):
    df = spark.createDataFrame([(1,), (0,), (None,), (2,)], "f int").coalesce(1)
    assert [r[0] for r in df.select(X.laundering_flag("f")).collect()] == ["Yes", "No", "No", "No"]


def test_pattern_time_never_fails(spark):
    texts = ["2022/09/01 00:20", "garbage", None, "2022-09-01 00:20:00", "2022/09/01 00:20:30", ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    got = df.select(X.parse_pattern_time("t").alias("ts")).collect()
    assert got[0].ts is not None and got[0].ts.hour == 0 and got[0].ts.minute == 20
    assert all(r.ts is None for r in got[1:])


def test_time_parts_utc(spark):
    df = spark.createDataFrame([("2024/01/07 10:05",)], "t string")  # a Sunday
    r = df.select(X.hour_of_day(X.parse_pattern_time("t")).alias("h"),
                  X.day_of_week(X.parse_pattern_time("t")).alias("d")).first()
    assert (r.h, r.d) == (10, 1)


def test_formats(spark):
    r = spark.range(1).select(
        X.hex_id(F.lit(1000000)).alias("hx"), X.padded_id("TRD", F.lit(12), 6).alias("p"),
        X.message_key(F.lit(None).cast("int")).alias("k0"), X.message_key(F.lit(17)).alias("k1"),
        X.format_transaction_time(F.to_timestamp(F.lit("2026-08-01 08:05:00"))).alias("f"),
        X.round_money(F.lit(2.345)).alias("r"),
    ).first()
    assert r.hx == "00F4240" and r.p == "TRD000012"
    assert r.k0 == "unknown" and r.k1 == "17"
    assert r.f == "2026/08/01 08:05" and r.r == 2.35


def test_money_sum_partitions_agree(spark):
    vals = [(0.1,), (0.2,), (0.3,)] * 1000
    a = spark.createDataFrame(vals, "x double").repartition(1).agg(X.money_sum("x")).first()[0]
    b = spark.createDataFrame(vals, "x double").repartition(7).agg(X.money_sum("x")).first()[0]
    assert abs(a - 600) < 1e-6 and abs(b - 600) < 1e-6


def test_money_keeps_small_large_and_infinite_amounts(spark):
    def both(*values):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        return tuple(df.agg(X.money_sum("x"), X.money_avg("x")).first())
    total, mean = both(0.004, 0.004, 0.004, None)
    assert abs(total - 0.012) < 1e-15 and abs(mean - 0.004) < 1e-15
    assert both(1e17, 1.0) == (1e17, 5e16)
    assert both(float("inf"), 1.0) == (float("inf"), float("inf"))
    assert both(None) == (None, None)
