import re

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import SF
from tradewind.llm import url_filter as U

URLS = [None, "", "no scheme casino", "http://", "http://a.com", "HTTP://WWW.Example.COM/en/x", "https://example.com/en/1", "https://m.example.com/en/1",
        "https://m.www.example.com/en/", "https://example.com/EN/1", "https://xexample.com/en/", "https://a.net/es/1", "https://a.net/fr/1?x#y", "https://a.net/fr",
        "https://net/es/", "https://a.netx/es/", "ftp://a.org/cheap-pills", "http://a.org/?q=free&p=free", "http://free-bets.org", "http://freebets.org/x",
        "http://casinos.org/", "http://casino", "://casino.org:80/a#://b", "http://a.org/Kİ?casino", "http://a.org/xécasino", "http://a@b.com:80/x?y/z",
        "http://win_win.org/bet", "http://a.org/" + "free/" * 5000, "http://a.com?x=/en/", "a/b?c=http://casino.com/en/", "http://bets-bet.org"]


def brute(url):
    m = re.search("://", url or "")
    host, path = "", ""
    if m:
        rest = url[m.end():]
        given_ = re.match("[^/?#]*", rest).group()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in given_)
        path = re.match("[^?#]*", rest[len(given_):]).group()
    fits = [(h + p, v) for h, p, v in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in url or "")
    score = sum(w for t, w in U.VOCABULARY.items() if re.search(rf"(?<![a-z0-9]){t}(?![a-z0-9])", low))
    rule, verdict = max(fits, key=lambda f: len(f[0])) if fits else (None, "block" if score >= 2 else "allow")
    return host, path, rule, verdict, score


def judged(url):
    host, path = U.host_path(url)
    score = sum(U.Vocabulary(U.VOCABULARY).hits(U.lowered(url or "")).values())
    return host, path, *(U.Rules(U.RULES).match(host, path) or (None, "block" if score >= 2 else "allow")), score


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["http", "://", "/", "?", "#", ".", "com", "net", "example", "www", "en", "es", "fr", "casino", "free", "bets", "-", "X", "İ", ":"]),
                max_size=14).map("".join))
def test_equals_brute_force(url):
    assert judged(url) == brute(url)


def test_edges(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, "http://casino"), (1, "http://a.com/x"), (1, "http://a.com/x")]
    df = spark.createDataFrame([(*r, "c", "d") for r in rows], "page_id long, url string, rule string, id string")
    out = U.judge_urls(df, carry=["page_id", "url", "rule", "id"])
    got = out.collect()
    assert out.columns == ["id", "host", "path", "rule", "verdict", "score", "terms", "page_id", "url", "rule", "id"]
    assert sorted([(r[0], r[8], *r[1:6], r[9], r[10]) for r in got], key=repr) == sorted([(i, u, *brute(u), "c", "d") for i, u in rows], key=repr)
    assert U.judge_urls(df.limit(0)).count() == 0
    assert [r.verdict for r in U.judge_urls(df.where("url = 'http://casino'"), [], {}).collect()] == ["allow"] * 2


def test_longest_rule_then_longer_host_then_block():
    rules = U.Rules([("com", "/abcd", "allow"), ("x.com", "/ab", "block"), ("x.com", "/ab", "allow")])
    assert rules.match("x.com", "/abcde") == ("x.com/ab", "block")
    assert rules.match("y.com", "/abcde") == ("com/abcd", "allow") and rules.match("com.", "/abcd") is None


def test_query_and_its_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE pages AS SELECT * FROM (VALUES " + ", ".join(["(NULL::BIGINT, 'http://casino')"] * 2) + ") t(page_id, url)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", list(enumerate(URLS)))
    want = {(r[0], r[1], r[2], r[3], r[4], r[5]) for r in con.sql(U.OP12_SQL).fetchall()}
    assert want == {(None, *brute("http://casino")), *((i, *brute(u)) for i, u in enumerate(URLS))}
    df = U.op12_url_filter(spark, SF)
    assert df.columns == ["page_id", "host", "path", "rule", "verdict", "score"]
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = df.collect()
    assert {tuple(r) for r in rows} == {(i, *brute(u)) for i, u in urls.items()} and len(rows) == len(urls)
    assert {r.verdict for r in rows} == {"allow", "block"}
