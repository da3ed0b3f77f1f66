from pyspark.sql import functions as F

from tradewind import operators as ops
from tradewind.operators import generate as gen


def _sample(spark, n=2000, parts=4):
    return gen.sample_trades(spark.range(0, n, 1, parts))


def test_quality_report_golden(spark):
    # 2000 sample trades: id % 137 == 0 -> 15 null amounts, id % 211 == 0 ->
    # 10 null exchanges, overlap at id 0 -> 24 removed, 1976 clean.
    r = ops.quality_report(_sample(spark)).first()
    assert (r.original_rows, r.cleaned_rows, r.removed_rows) == (2000, 1976, 24)
    assert (r.null_amount_usd, r.null_exchange) == (15, 10)
    assert ops.clean_trades(_sample(spark)).count() == 1976


def test_dropna_also_drops_nan(spark):
    df = spark.createDataFrame([(float("nan"), "A"), (1.0, "B"), (None, "C"), (2.0, None)],
                               "amount_usd double, exchange string")
    assert ops.drop_incomplete(df).count() == 1
    r = ops.quality_report(df).first()
    assert (r.original_rows, r.cleaned_rows, r.removed_rows) == (4, 1, 3)


def test_whale_filter_strict(spark):
    df = spark.createDataFrame([(1, "A", 100000.0), (2, "A", 100000.01), (3, "A", None)],
                               "trade_id int, exchange string, amount_usd double")
    assert [r.trade_id for r in ops.whale_trades(df).collect()] == [2]


def test_exchange_stats_order_and_top(spark):
    df = spark.createDataFrame([("A", 1.0), ("B", 5.0), ("B", 1.0), ("C", 6.0)],
                               "exchange string, amount_usd double")
    stats = ops.exchange_stats(df).collect()
    assert [r.exchange for r in stats] == ["B", "C", "A"]  # 6.0 tie broken by name
    assert stats[0].trade_count == 2 and stats[0].avg_trade_size == 3.0
    assert ops.top_exchange(ops.exchange_stats(df)).first().exchange == "B"


def test_trade_summary_matches_parts(spark):
    t = _sample(spark)
    s = ops.trade_summary(t).first()
    assert s.total_trades == 2000 and s.cleaned_trades == 1976
    assert s.whale_trades == t.filter(F.col("amount_usd") > 100000).count()
    assert s.top_exchange == ops.top_exchange(ops.exchange_stats(ops.clean_trades(t))).first().exchange


def test_empty_input(spark):
    empty = spark.createDataFrame([], "amount_received double, is_laundering string, is_laundering_flag int")
    d = ops.amount_summary(empty, "amount_received").first()
    assert d["count"] == 0 and d["mean"] is None and d["stddev"] is None
    assert ops.share_of_total(empty, "is_laundering").count() == 0
    t = ops.flag_tally(empty).first()
    assert t.sent == 0 and t.flagged == 0 and t.flagged_pct is None
    desc = {r.summary: r.amount_received for r in ops.describe_column(empty, "amount_received").collect()}
    assert desc["count"] == "0"


def test_share_of_total(spark):
    df = spark.createDataFrame([("Yes",), ("No",), ("No",), ("No",)], "f string")
    got = {r.f: (r["count"], r.pct) for r in ops.share_of_total(df, "f").collect()}
    assert got == {"Yes": (1, 25.0), "No": (3, 75.0)}


def test_hour_stats_null_first(spark):
    rows = [(None,)] + [(h,) for h in range(24)]
    df = spark.createDataFrame(rows, "hour_of_day int")
    got = [r.hour_of_day for r in ops.hour_stats(df).collect()]
    assert got == [None, *range(24)]


def test_frequency_profile_top_n(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (3,), (3,), (3,), (None,)], "b int")
    got = [(r.b, r["count"]) for r in ops.frequency_profile(df, "b", 2).collect()]
    assert got == [(3, 3), (1, 2)]


def test_head_and_fill(spark):
    df = spark.createDataFrame([(3, None), (1, "x"), (2, "y")], "k int, s string")
    assert [r.k for r in ops.head(df, 2, "k").collect()] == [1, 2]
    assert ops.head(df, 0, "k").count() == 3
    assert ops.fill_nulls(df, "", ["s"]).filter("s = ''").count() == 1


def test_replay_cycles(spark):
    df = spark.range(5)
    out = ops.replay_cycles(df, 3)
    assert out.count() == 15
    assert sorted(r.cycle for r in out.select("cycle").distinct().collect()) == [1, 2, 3]
