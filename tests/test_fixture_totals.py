"""Totals stated in FIXTURES.md for sf0.01 (an independent check of the views)."""
import os

import pytest
from pyspark.sql import functions as F

from tradewind import operators as ops
from tradewind import streaming as st
from tradewind.sources import views

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="sf0.01 tables absent")


def test_trade_totals(spark):
    t = views.trades(spark, SF)
    r = t.agg(F.count(F.lit(1)).alias("rows"), F.count("amount_usd").alias("amt"),
              F.count("exchange").alias("ex")).first()
    assert (r.rows, r.amt, r.ex) == (10000, 9927, 9952)
    assert ops.clean_trades(t).count() == 9880
    assert ops.whale_trades(t).count() == 1311
    windows = st.windowed_trade_stats(st.with_event_time(t), watermark=None)
    assert windows.count() == 9791


def test_transaction_totals(spark):
    e = ops.enrich_transactions(views.transactions(spark, SF))
    tiers = {r.amount_category: r["count"] for r in ops.tier_stats(e).collect()}
    assert tiers == {"HIGH": 54728, "MEDIUM": 5162, "LOW": 110}
    assert e.filter("amount_category = 'LOW' AND amount_received IS NULL").count() == 65
    assert e.filter("is_laundering = 'Yes'").count() == 57


def test_unmatched_count(spark):
    clean = ops.clean_trades(views.trades(spark, SF))
    assert ops.unmatched(clean, views.traders(spark, SF)).count() == 9542
