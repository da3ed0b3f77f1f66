from pyspark.sql import functions as F

from tradewind.operators import generate as gen
from tradewind.sources import views
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_partition_invariance(spark):
    for fn in (gen.sample_trades, gen.stream_trades, gen.synthetic_transactions):
        one = fn(spark.range(0, 3000, 1, 1))
        many = fn(spark.range(0, 3000, 1, 8))
        assert _rows(one) == _rows(many)


def test_sample_domains(spark):
    t = gen.sample_trades(spark.range(0, 5000, 1, 4))
    r = t.agg(F.min("amount_usd").alias("lo"), F.max("amount_usd").alias("hi"),
              F.countDistinct("exchange").alias("ex"), F.countDistinct("coin").alias("coins"),
              F.count_if((F.col("amount_usd") > 5000) & (F.col("amount_usd") < 100000)).alias("gap")).first()
    assert r.lo >= 50 and r.hi <= 500000 and r.ex == 5 and r.coins == 5 and r.gap == 0
    whales = t.filter(F.col("amount_usd") >= 100000).count()
    assert 0.4 < whales / t.filter(F.col("amount_usd").isNotNull()).count() < 0.6


def test_synthetic_domains(spark):
    t = gen.synthetic_transactions(spark.range(0, 20000, 1, 4))
    r = t.agg(F.min("from_bank").alias("b0"), F.max("from_bank").alias("b1"),
              F.min("amount_paid").alias("a0"), F.max("amount_paid").alias("a1"),
              F.count_if(F.col("amount_paid") != F.col("amount_received")).alias("diff"),
              F.min(F.length("from_account")).alias("l0"), F.max(F.length("from_account")).alias("l1"),
              F.sum("is_laundering_flag").alias("flags")).first()
    assert 1 <= r.b0 and r.b1 <= 49999 and 1 <= r.a0 and r.a1 <= 50000 and r.diff == 0
    assert r.l0 == r.l1 == 7
    assert 5 <= r.flags <= 45     # rate 0.001 of 20000


def test_dense_index_paths_agree(spark):
    df = spark.range(0, 5000, 1, 6).select((F.col("id") * 7919 % 5003).alias("v"))
    order = [F.col("v").desc(), F.col("v")]
    local = gen.dense_index(df, order)
    dist = gen.dense_index(df, order, max_local_rows=10)
    assert _rows(local.select("idx", "v")) == _rows(dist.select("idx", "v"))
    assert sorted(r.idx for r in dist.collect()) == list(range(5000))


def test_profiled_uses_profile(spark):
    hist = views.transactions(spark, SF_SMALL)
    out = gen.profiled_transactions(spark.range(0, 2000, 1, 3), hist)
    banks = {r.from_bank for r in hist.groupBy("from_bank").count()
             .orderBy(F.desc("count"), "from_bank").limit(1000).collect()}
    got = out.collect()
    assert len(got) == 2000
    assert {r.from_bank for r in got} <= banks and {r.to_bank for r in got} <= banks
    currencies = {r.receiving_currency for r in hist.select("receiving_currency").distinct().collect()}
    assert {r.receiving_currency for r in got} <= currencies
    assert all(r.amount_paid == r.amount_received and 5 <= r.amount_paid <= 50000 for r in got)


def test_profiled_top_banks_limit(spark):
    hist = views.transactions(spark, SF_SMALL)
    top = {r.from_bank for r in hist.groupBy("from_bank").count()
           .orderBy(F.desc("count"), "from_bank").limit(3).collect()}
    out = gen.profiled_transactions(spark.range(0, 500, 1, 2), hist, top_banks=3).collect()
    assert {r.from_bank for r in out} == top and {r.to_bank for r in out} == top
