import duckdb
from pyspark.sql import functions as F

from tests.llm.helpers import SF
from tradewind.llm import warc as R

FIELDS = "record_id long, url string, ts long, kind string, etag string, last_modified string, digest string, headers map<string,string>"


def _resolve(spark, rows):
    df = spark.createDataFrame(rows, FIELDS)
    clash = df.selectExpr("*", "1 AS uri", "2 AS stretch", "3 AS outcome", "4 AS at")
    return {r.record_id: r for r in R.resolve_revisits(clash).collect()}


def test_query_matches_duckdb(spark):
    out = R.op6_warc_revisits(spark, SF)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF}/pages.parquet')")
    cur = con.execute(R.OP6_SQL)
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(out.columns)
    assert sorted(tuple(r) for r in out.select(*names).collect()) == sorted(cur.fetchall())


def test_canonical_urls(spark):
    urls = ["http://WWW.Example.org/a/?b=2&utm_source=x&a=1#top", "https://example.org/a?a=1&b=2", "example.org", "http://example.org/?ref=z", "", None]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [r.c for r in df.select(R.canonical_url(F.col("u")).alias("c")).collect()]
    assert got == ["example.org/a?a=1&b=2", "example.org/a?a=1&b=2", "example.org", "example.org", "", None]


def test_outcomes(spark):
    u, v = "http://a.org/x", "https://www.a.org/x/"
    got = _resolve(spark, [
        (1, u, 10, "response", '"e1"', "m1", "d1", {"etag": '"e1"', "content-length": "5", "date": "1", "x-own": "k"}),
        (2, v, 20, "revisit", 'W/"e1"', None, None, {"date": "2", "content-length": "0", "x-new": "n", "expires": "9"}),
        (3, v, 5, "revisit", '"e1"', None, None, {"date": "0"}),                      # before any response
        (4, v, 30, "response", '"e2"', "m2", "d2", {"etag": '"e2"'}),
        (5, u, 40, "revisit", '"e1"', "m2", "d2", None),                              # the latest has another tag
        (6, u, 50, "revisit", None, "m2", "other", {"date": "6"}),                    # times decide before digests
        (7, u, 60, "revisit", None, None, "d2", None),
        (8, u, 70, "revisit", None, None, None, {}),                                  # nothing to compare
        (9, None, 70, "revisit", '"e1"', None, "d", {"date": "9"}),
        (10, u, None, "revisit", '"e1"', None, None, None),
        (11, u, 30, "revisit", '"e2"', None, None, None),                             # same time, larger id
        (0, u, 30, "revisit", '"e2"', None, None, None),                              # same time, smaller id
    ])
    assert {k: (r.outcome, r.resolved_id) for k, r in got.items()} == {
        1: ("full", 1), 2: ("resolved", 1), 3: ("orphan", None), 4: ("full", 4), 5: ("mismatch", None), 6: ("resolved", 4), 7: ("resolved", 4),
        8: ("mismatch", None), 9: ("orphan", None), 10: ("orphan", None), 11: ("resolved", 4), 0: ("mismatch", None)}
    assert got[2].headers == {"etag": '"e1"', "content-length": "5", "date": "2", "x-own": "k", "expires": "9"}
    assert got[2].digest == "d1" and got[5].digest == "d2" and got[9].headers == {"date": "9"}
    assert _resolve(spark, []) == {}


def test_hot_url_over_many_stretches(spark, monkeypatch):
    monkeypatch.setattr(R, "STRETCH", 7)
    rows = [(i, "http://hot.org/", i, "response" if i % 10 == 0 else "revisit", f'"e{i // 10 * 10}"', None, "d", {}) for i in range(300)]
    got = _resolve(spark, rows + rows[5:6])
    assert len(got) == 300 and all(r.resolved_id == k // 10 * 10 for k, r in got.items())
