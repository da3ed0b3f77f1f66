from tradewind import operators as ops


def _trades(spark):
    rows = [(i, f"T{i % 7}", float(i)) for i in range(200)] + [(999, None, 1.0)]
    return spark.createDataFrame(rows, "trade_id int, trader_id string, amount_usd double")


def _lookup(spark):
    return spark.createDataFrame(
        [("T1", "Ann", "LOW"), ("T2", None, "HIGH"), ("T3", "Cy", "LOW"), ("T3", "Cy2", "MEDIUM")],
        "trader_id string, trader_name string, risk_level string")


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_lookup_join_paths_agree(spark):
    t, lk = _trades(spark), _lookup(spark)
    broadcast = ops.lookup_join(t, lk, "trader_id", "left", broadcast=True)
    shuffle = ops.lookup_join(t, lk, "trader_id", "left")
    salted = ops.lookup_join(t, lk, "trader_id", "left", salt_buckets=5)
    assert _rows(broadcast) == _rows(shuffle) == _rows(salted)
    # T3 has two lookup rows: its trades appear twice, as a left join does.
    n_t3 = t.filter("trader_id = 'T3'").count()
    assert broadcast.filter("trader_id = 'T3'").count() == 2 * n_t3


def test_unmatched_is_anti_join(spark):
    t, lk = _trades(spark), _lookup(spark)
    un = ops.unmatched(t, lk, "trader_id", ["trade_id", "trader_id", "amount_usd"])
    keys = {r.trader_id for r in un.select("trader_id").distinct().collect()}
    # A matched trader with a null name (T2) is not unmatched; a null key is.
    assert "T2" not in keys and None in keys and "T1" not in keys
    salted = ops.unmatched(t, lk, "trader_id", salt_buckets=4)
    assert _rows(un) == _rows(salted.select("trade_id", "trader_id", "amount_usd"))


def test_broadcast_on_request(spark):
    t, lk = _trades(spark), _lookup(spark)
    plan = ops.lookup_join(t, lk, "trader_id", broadcast=True)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    salted = ops.lookup_join(t, lk.hint("merge"), "trader_id", salt_buckets=4)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in salted


def test_inline_trader_lookup_with_sample_trades(spark):
    from pyspark.sql import functions as F
    from tradewind.operators import generate as gen
    from tradewind.sources import trader_lookup
    lk = trader_lookup(spark)
    assert lk.count() == 5
    trades = ops.clean_trades(gen.sample_trades(spark.range(0, 2000, 1, 4)))
    joined = ops.lookup_join(trades, lk, "trader_id", "left")
    ids = [r[0] for r in lk.select("trader_id").collect()]
    matched = joined.filter(F.col("trader_name").isNotNull()).count()
    assert matched == trades.filter(F.col("trader_id").isin(ids)).count()
    assert ops.unmatched(trades, lk).count() == trades.count() - matched


def test_hot_key_third_of_rows(spark):
    """One trader holds a third of all trades: AQE splits the hot partition
    of the shuffle join (thresholds lowered for the test), salting spreads
    it, and both give the broadcast join's rows."""
    from pyspark.sql import functions as F
    n = 30000
    trades = spark.range(0, n, 1, 8).select(
        F.col("id").alias("trade_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 997).alias("trader_id"),
        (F.col("id") % 1000).cast("double").alias("amount_usd"))
    lookup = spark.range(0, 997, 1, 4).select(F.col("id").alias("trader_id"),
                                              F.concat(F.lit("name"), F.col("id")).alias("trader_name"))
    expected = ops.lookup_join(trades, lookup, "trader_id").agg(
        F.count(F.lit(1)), F.sum("trade_id"), F.count("trader_name")).first()
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096"}
    from tradewind.session import session_conf
    with session_conf(spark, conf):
        shuffled = ops.lookup_join(trades, lookup, "trader_id")
        got = shuffled.agg(F.count(F.lit(1)), F.sum("trade_id"), F.count("trader_name")).first()
        plan = shuffled._jdf.queryExecution().executedPlan().toString()
        shuffled.collect()  # finalises this frame's own adaptive plan
        final = shuffled._jdf.queryExecution().executedPlan().toString()
        salted = ops.lookup_join(trades, lookup, "trader_id", salt_buckets=16).agg(
            F.count(F.lit(1)), F.sum("trade_id"), F.count("trader_name")).first()
    assert tuple(got) == tuple(expected) == tuple(salted)
    assert "SortMergeJoin" in plan
    assert "skew=true" in final
