"""Resolution of not-modified revisit records.

A revisit says that a page had not changed since it was last captured. Each is
joined, by canonical URL and time, to the latest earlier full response; its
validators are checked against that response's; and the headers that a
not-modified answer may update are merged into the stored ones.

The as-of join is a window per URL and stretch of time. A URL's stretches hold
a bounded share of its records, and the last response of each stretch is
carried into the next ones by a window over stretches, so one URL with a third
of all records is spread over many tasks. Payloads do not move: a resolved
record names the response that holds its payload.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewind.llm.common import materialize, read

STRETCH = 50_000  # records that one stretch of time holds on average, all URLs together

#: Header fields that a not-modified response may update
#: (RFC 9110, section 15.4.5, and Last-Modified).
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]


def canonical_url(url: Column) -> Column:
    """Without scheme, ``www.``, fragment, tracking parameters (``utm_*``,
    ``ref``) and closing slashes; host in lower case; parameters sorted."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z]+://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, "^([^/?]*)", 1)), "^www[.]", "")
    path = F.regexp_replace(F.regexp_extract(bare, "^[^/?]*([^?]*)", 1), "/+$", "")
    asked = F.split(F.regexp_extract(bare, "[?](.*)$", 1), "&")
    kept = F.array_join(F.array_sort(F.filter(asked, lambda p: ~p.rlike("^(utm_[a-z]+|ref)(=|$)") & (p != ""))), "&")
    return F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))


def strong(etag: Column) -> Column:
    """An entity tag for weak comparison: without its ``W/``."""
    return F.regexp_replace(etag, "^W/", "")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``records``: record_id long, url, ts long, kind (``response`` or
    ``revisit``), etag, last_modified, digest, headers map<string,string> with
    names in lower case. Returns record_id, uri, ts, kind, ``outcome``,
    ``resolved_id`` long, ``digest`` and ``headers``.

    Outcomes: ``full`` (a response), ``resolved``, ``mismatch`` (the latest
    earlier response has other validators), ``orphan`` (there is none). Entity
    tags decide if both records have one, else last-modified times, else
    digests; if nothing can be compared it is a mismatch. A mismatch or orphan
    keeps its own headers and resolves to nothing. Earlier means a smaller
    time, or at the same time a smaller record_id; repeated rows stay. Null
    times count as before all others; a null URL never resolves.
    """
    rows = records.select("record_id", canonical_url(F.col("url")).alias("uri"), F.coalesce(F.col("ts"), F.lit(-(1 << 62))).alias("at"), "ts", "kind",
                          "etag", "last_modified", "digest", "headers")
    rows = materialize(rows, "warc")
    span = rows.agg(F.count("*").alias("n"), F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    stretches = max(1, -(-span["n"] // STRETCH))
    width = max(1, -(-((span["hi"] or 0) - (span["lo"] or 0) + 1) // stretches))
    rows = rows.withColumn("stretch", F.coalesce(F.floor((F.col("ts") - (span["lo"] or 0)) / width), F.lit(-1)))
    full = F.when(F.col("kind") == "response", F.struct("at", "record_id", "etag", "last_modified", "digest", "headers"))

    ends = (rows.where("kind = 'response' and uri is not null").groupBy("uri", "stretch")
            .agg(F.max_by(full, F.struct("at", "record_id")).alias("end")))
    places = rows.where("uri is not null").select("uri", "stretch").distinct().join(ends, ["uri", "stretch"], "left")
    before = W.partitionBy("uri").orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    carried = places.select("uri", "stretch", F.last("end", ignorenulls=True).over(before).alias("carried"))

    inside = W.partitionBy("uri", "stretch").orderBy("at", "record_id").rowsBetween(W.unboundedPreceding, -1)
    seen = rows.where("kind = 'revisit' and uri is not null or kind = 'response'").withColumn("near", F.last(full, ignorenulls=True).over(inside))
    seen = seen.join(carried, ["uri", "stretch"], "left").withColumn("base", F.coalesce("near", "carried"))

    same = F.coalesce(strong(F.col("etag")) == strong(F.col("base.etag")), F.col("last_modified") == F.col("base.last_modified"),
                      F.col("digest") == F.col("base.digest"), F.lit(False))
    outcome = (F.when(F.col("kind") == "response", "full").when(F.col("base").isNull(), "orphan").when(same, "resolved").otherwise("mismatch"))
    allowed = F.map_filter("headers", lambda k, v: F.lower(k).isin(PERMITTED))
    stored = F.map_filter("base.headers", lambda k, v: ~F.array_contains(F.map_keys(allowed), k))
    out = seen.withColumn("outcome", outcome)
    lost = rows.where("kind = 'revisit' and uri is null").select(
        "record_id", "uri", "ts", "kind", F.lit("orphan").alias("outcome"), F.lit(None).cast("long").alias("resolved_id"), "digest", "headers")
    hit = F.col("outcome") == "resolved"
    return out.select("record_id", "uri", "ts", "kind", "outcome",
                      F.when(F.col("kind") == "response", F.col("record_id")).when(hit, F.col("base.record_id")).alias("resolved_id"),
                      F.when(hit, F.col("base.digest")).otherwise(F.col("digest")).alias("digest"),
                      F.when(hit, F.map_concat(stored, allowed)).otherwise(F.col("headers")).alias("headers")).unionByName(lost)


def capture_log(pages: DataFrame) -> DataFrame:
    """Captures derived from ``pages``, four rounds over the site: every page in
    full; a revisit (of another spelling of the URL; one in seven with a
    foreign entity tag, one in five with a date only); one page in three anew
    with other content; a revisit that names the newest content."""
    page = F.col("page_id").cast("long")
    body = F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary"))
    newer = F.sha1(F.concat(body, F.lit("2")).cast("binary"))
    again = page % 3 == 0
    rounds = F.array(*[F.struct(F.lit(i).alias("round"), kind.alias("kind"), digest.alias("digest")) for i, kind, digest in (
        (0, F.lit("response"), body), (1, F.lit("revisit"), body), (2, F.when(again, F.lit("response")), newer),
        (3, F.lit("revisit"), F.when(again, newer).otherwise(body)))])
    rows = pages.select(page.alias("page"), F.col("url"), F.explode(rounds).alias("c")).select("page", "url", "c.*").where("kind is not null")
    foreign = (F.col("round") == 1) & (F.col("page") % 7 == 0)
    dated = (F.col("round") == 1) & (F.col("page") % 5 == 0)
    etag = F.when(foreign, F.lit('"foreign"')).when(~dated, F.concat(F.when(F.col("round") == 3, "W/").otherwise(""), F.lit('"'), F.substring("digest", 1, 12), F.lit('"')))
    changed = F.concat(F.lit("day "), F.when((F.col("round") >= 2) & (F.col("page") % 3 == 0), 2).otherwise(0).cast("string"))
    ts = F.col("page") + F.col("round") * F.lit(1 << 40)
    headers = F.map_from_entries(F.filter(F.array(
        F.struct(F.lit("date").alias("k"), ts.cast("string").alias("v")), F.struct(F.lit("etag").alias("k"), etag.alias("v")),
        F.struct(F.lit("content-length").alias("k"), F.when(F.col("kind") == "response", F.length("digest") + F.col("page")).otherwise(0).cast("string").alias("v")),
        F.struct(F.lit("x-round").alias("k"), F.col("round").cast("string").alias("v"))), lambda e: e["v"].isNotNull()))
    spelled = F.when(F.col("round") == 1, F.concat(F.col("url"), F.when(F.col("url").contains("#"), "x").when(F.col("url").contains("?"), "&utm_x=1").otherwise("?ref=r"))).otherwise(F.col("url"))
    return rows.select((F.col("page") * 4 + F.col("round")).alias("record_id"), spelled.alias("url"), ts.alias("ts"), "kind",
                       etag.alias("etag"), changed.alias("last_modified"), F.when(F.col("kind") == "response", F.col("digest")).alias("digest"), headers.alias("headers"))


def op6_warc_revisits(spark, sf_dir: str) -> DataFrame:
    """Every capture of every page, with revisits resolved; headers as sorted
    ``name: value`` lines."""
    out = resolve_revisits(capture_log(read(spark, sf_dir, "pages")))
    lines = F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))), "\n")
    return out.select("record_id", "uri", "ts", "kind", "outcome", "resolved_id", "digest", lines.alias("headers"))


OP6_SQL = r"""
WITH c AS (
  SELECT page_id AS page, url, r.round, sha1(coalesce(html, '')) AS body FROM pages, (VALUES (0), (1), (2), (3)) r(round)
  WHERE r.round <> 2 OR page_id % 3 = 0),
d AS (SELECT page, url, round, CASE WHEN round IN (0, 2) THEN 'response' ELSE 'revisit' END AS kind,
        CASE WHEN round >= 2 AND page % 3 = 0 THEN sha1(body || '2') ELSE body END AS digest,
        page + round * 1099511627776 AS ts FROM c),
e AS (SELECT page * 4 + round AS record_id, ts, kind, round, page, digest AS named,
        CASE WHEN round <> 1 THEN url WHEN contains(url, '#') THEN url || 'x' WHEN contains(url, '?') THEN url || '&utm_x=1' ELSE url || '?ref=r' END AS spelled,
        CASE WHEN round = 1 AND page % 7 = 0 THEN '"foreign"' WHEN round = 1 AND page % 5 = 0 THEN NULL
             ELSE (CASE WHEN round = 3 THEN 'W/' ELSE '' END) || '"' || substr(digest, 1, 12) || '"' END AS etag,
        'day ' || CASE WHEN round >= 2 AND page % 3 = 0 THEN '2' ELSE '0' END AS modified,
        CASE WHEN kind = 'response' THEN digest END AS digest,
        CASE WHEN kind = 'response' THEN length(digest) + page ELSE 0 END AS size FROM d),
b AS (SELECT *, regexp_replace(regexp_replace(trim(spelled), '#.*$', ''), '^[A-Za-z]+://', '') AS bare FROM e),
u AS (SELECT *, regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)), '^www[.]', '')
        || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') AS place,
        array_to_string(list_sort(list_filter(string_split(regexp_extract(bare, '[?](.*)$', 1), '&'),
          lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref)(=|$)'))), '&') AS asked FROM b),
v AS (SELECT *, place || CASE WHEN asked <> '' THEN '?' || asked ELSE '' END AS uri FROM u),
j AS (SELECT a.*, f.record_id AS base_id, f.etag AS base_etag, f.modified AS base_modified, f.digest AS base_digest, f.ts AS base_ts, f.size AS base_size, f.round AS base_round,
        row_number() OVER (PARTITION BY a.record_id ORDER BY f.ts DESC NULLS LAST, f.record_id DESC) AS nth
      FROM v a LEFT JOIN v f ON f.uri = a.uri AND f.kind = 'response' AND (f.ts, f.record_id) < (a.ts, a.record_id)),
o AS (SELECT *, CASE WHEN kind = 'response' THEN 'full' WHEN base_id IS NULL THEN 'orphan'
        WHEN coalesce(regexp_replace(etag, '^W/', '') = regexp_replace(base_etag, '^W/', ''), modified = base_modified, false) THEN 'resolved' ELSE 'mismatch' END AS outcome
      FROM j WHERE nth = 1)
SELECT record_id, uri, ts, kind, outcome, CASE WHEN kind = 'response' THEN record_id WHEN outcome = 'resolved' THEN base_id END AS resolved_id,
  CASE WHEN outcome = 'resolved' THEN base_digest ELSE digest END AS digest,
  CASE WHEN outcome = 'resolved'
    THEN 'content-length: ' || base_size || chr(10) || 'date: ' || ts || coalesce(chr(10) || 'etag: ' || coalesce(etag, base_etag), '') || chr(10) || 'x-round: ' || base_round
    ELSE 'content-length: ' || size || chr(10) || 'date: ' || ts || coalesce(chr(10) || 'etag: ' || etag, '') || chr(10) || 'x-round: ' || round END AS headers
FROM o
"""
