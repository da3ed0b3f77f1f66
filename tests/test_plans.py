"""Physical-plan properties the library relies on for scale."""
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tradewind.plans import QUERIES

STREAMING = {"windowed_trades_stream", "windowed_trades_complete", "windowed_trades_append",
             "stream_enrich_sink", "stream_enrich_batches", "stream_summary", "generated_trade_windows"}


def _plan(df, executed=False):
    if executed:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _q(spark, name):
    return E.queries()[name](spark, SF_SMALL)


def test_filter_and_pruning_reach_the_scan(spark):
    p = _plan(_q(spark, "unmatched_trades"))
    assert "PushedFilters: [In(c_custkey, [1,10,20,5,50]), IsNotNull(c_custkey)]" in p
    assert "ReadSchema: struct<c_custkey:bigint>" in p
    whale = _plan(_q(spark, "whale_trades"))
    assert "ReadSchema: struct<event_id:bigint,event_type:string,value:double>" in whale


def test_aggregates_are_partial_then_final(spark):
    for name in ("exchange_stats", "tier_stats", "weekday_stats", "laundering_counts", "bank_profile"):
        p = _plan(_q(spark, name))
        assert "partial_" in p, name


def test_small_lookup_is_broadcast_and_unmatched_is_anti(spark):
    p = _plan(_q(spark, "unmatched_trades"))
    assert "BroadcastHashJoin" in p and "LeftAnti" in p
    assert "BroadcastHashJoin" in _plan(_q(spark, "trader_join"))


def test_large_lookup_is_salted_shuffle_join(spark):
    from tradewind import operators as ops
    from tradewind.sources import views
    trades = ops.clean_trades(views.trades(spark, SF_SMALL))
    lookup = views.traders(spark, SF_SMALL, keys=None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = _plan(ops.lookup_join(trades, lookup, "trader_id", salt_buckets=4))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in p and "__salt" in p and "BroadcastExchange" not in p


def test_share_total_reuses_the_grouping_shuffle(spark):
    assert "ReusedExchange" in _plan(_q(spark, "laundering_share"), executed=True)


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(_q(spark, "top_exchange"))
    assert "TakeOrderedAndProject" in _plan(_q(spark, "head_n"))


def test_decode_parses_once(spark):
    p = _plan(_q(spark, "decoded_messages"))
    assert p.count("from_json") == 1 and "Generate" in p


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMING))
def test_no_cartesian_or_nested_loop(spark, name):
    p = _plan(_q(spark, name))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
