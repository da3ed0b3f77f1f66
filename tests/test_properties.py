"""Property tests: column expressions against plain-Python models."""
import math
from decimal import Decimal

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tradewind import functions as X

amounts = st.one_of(st.none(), st.just(float("nan")), st.sampled_from([1000.0, 10000.0, 1000.01, 10000.01]),
                    st.floats(min_value=-1e7, max_value=1e7, allow_nan=False))


def tier_model(a):
    if a is None:
        return "LOW"
    if math.isnan(a) or a > 10000:
        return "HIGH"
    return "MEDIUM" if a > 1000 else "LOW"


@settings(max_examples=15, deadline=None)
@given(st.lists(amounts, min_size=1, max_size=60))
def test_amount_tier_model(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, a double")
    got = {r.i: r.t for r in df.select("i", X.amount_tier("a").alias("t")).collect()}
    assert [got[i] for i in range(len(values))] == [tier_model(v) for v in values]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(min_value=-10**9, max_value=10**9), min_size=1, max_size=200),
       st.integers(min_value=1, max_value=9))
def test_money_sum_is_right_to_the_cent(spark, cents, parts):
    rows = [(c / 100.0,) for c in cents]
    df = spark.createDataFrame(rows, "x double").repartition(parts)
    got = df.agg(X.money_sum("x").alias("s")).first().s
    exact = sum(Decimal(c) / 100 for c in cents)
    assert abs(got - float(exact)) < 0.005


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(min_value=-3, max_value=3)), min_size=1, max_size=40))
def test_laundering_flag_model(spark, flags):
    df = spark.createDataFrame([(i, f) for i, f in enumerate(flags)], "i int, f int")
    got = {r.i: r.y for r in df.select("i", X.laundering_flag("f").alias("y")).collect()}
    assert [got[i] for i in range(len(flags))] == ["Yes" if f == 1 else "No" for f in flags]
    assert F is not None
