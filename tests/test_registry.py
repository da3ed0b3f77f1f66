"""Every registered query against its DuckDB oracle on the smallest tables."""
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tradewind.plans import ORACLE_SQL, QUERIES

TABLES = ["customer", "orders", "lineitem", "events"]


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return "NaN" if math.isnan(v) else float(f"{v:.9g}")
        return v.isoformat() if hasattr(v, "isoformat") else v
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows, cols = [tuple(r) for r in df.collect()], df.columns
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _canon(rows, cols) == _canon(orows, ocols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["exchange", "trade_count", "total_volume", "avg_trade_size", "max_trade_size"]
    assert df.count() >= 1
    assert os.path.exists(SF_SMALL)
