"""URL filter: rules for hosts and paths, then a weighted vocabulary.

A rule names a host and the beginning of a path; it fits that host and all its
subdomains, and the longest fitting rule decides. Every other URL is judged by
its words: one Aho-Corasick automaton, built once a worker, finds all terms of
the vocabulary in one pass over the lower-cased URL, and a hit counts only if no
ASCII letter or digit stands beside it. Each distinct term adds its weight once;
a URL whose weights reach ``LIMIT`` is blocked, so one strict term is enough and
soft terms need company. Only the URL column is read; nothing is shuffled.
"""
from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import carried, read, text_batches

#: Sum of weights from which a URL is blocked.
LIMIT = 2
STRICT, SOFT = LIMIT, 1
#: Term -> weight; lower case. A parameter of ``judge_urls``.
VOCABULARY = {
    **dict.fromkeys(["adult", "casino", "escort", "hentai", "jackpot", "phishing", "porn", "viagra", "warez", "xxx"], STRICT),
    **dict.fromkeys(["ads", "bet", "bets", "bonus", "cheap", "click", "crack", "dating", "farm", "free", "keygen", "loan", "lottery",
                     "nude", "pills", "poker", "prize", "sex", "slots", "spam", "torrent", "track", "win"], SOFT)}

ALLOW, BLOCK = "allow", "block"
#: (host, beginning of the path, verdict).
RULES = [("com", "/", ALLOW), ("example.com", "/en/", BLOCK), ("www.example.com", "/en/", ALLOW), ("net", "/es/", BLOCK), ("net", "/fr/", BLOCK)]

_UPPER = {c: c + 32 for c in range(0x41, 0x5B)}
_HOST = re.compile(r"[^/?#]*")
_PATH = re.compile(r"[^?#]*")
_BESIDE = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def lowered(text: str) -> str:
    """A-Z in lower case, every other code point as it is."""
    return text.lower() if text.isascii() else text.translate(_UPPER)


def host_path(url: str | None) -> tuple[str, str]:
    """Host (what stands between the first ``://`` and ``/``, ``?``, ``#`` or
    the end, port and user included) and path; both empty without ``://``."""
    at = -1 if url is None else url.find("://")
    if at < 0:
        return "", ""
    host = _HOST.match(url, at + 3)
    return lowered(host.group()), _PATH.match(url, host.end()).group()


class Rules:
    """The longest rule (host and path together) that fits; of two as long, the
    one with the longer host, then the blocking one."""

    def __init__(self, rules):
        self.of_host: dict[str, list] = {}
        for host, path, verdict in rules:
            if not host or verdict not in (ALLOW, BLOCK):
                raise ValueError(f"rule needs a host and a verdict: {(host, path, verdict)}")
            host = lowered(host)
            self.of_host.setdefault(host, []).append((len(host) + len(path), len(host), verdict == BLOCK, path, host + path, verdict))

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        found = []
        while host:
            found += [r for r in self.of_host.get(host, ()) if path.startswith(r[3])]
            host = host.partition(".")[2]
        return max(found)[4:] if found else None


class Vocabulary:
    def __init__(self, weights: dict[str, int]):
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        for term, weight in weights.items():
            if not term or lowered(term) != term:
                raise ValueError(f"terms are lower case and not empty: {term!r}")
            self.automaton.add_word(term, (term, weight))
        self.automaton.make_automaton()
        self.empty = not weights

    def hits(self, text: str) -> dict[str, int]:
        """Distinct terms of ``text`` with their weights."""
        out = {}
        if self.empty or not text:
            return out
        for end, (term, weight) in self.automaton.iter(text):
            start = end - len(term) + 1
            if (not start or text[start - 1] not in _BESIDE) and (end + 1 == len(text) or text[end + 1] not in _BESIDE):
                out[term] = weight
        return out


def judge_urls(df: DataFrame, rules=RULES, vocabulary: dict[str, int] = VOCABULARY, limit: int = LIMIT,
               id_col: str = "page_id", url_col: str = "url", carry: list[str] | None = None) -> DataFrame:
    """``id``, ``host``, ``path``, ``rule`` (host and path of the rule that
    decided, else null), ``verdict`` (``allow`` or ``block``), ``score`` (weights
    of the distinct terms in the whole URL) and ``terms`` (these, sorted).

    A null or empty URL and one without ``://`` has an empty host and path, so no
    rule fits; a null one has no terms either and is allowed. Repeated rows and null ids are
    answered like any others; an empty table gives an empty result. Columns in
    ``carry`` follow under their own names. Rules and vocabulary travel with the
    task: lists that a user writes down, not data."""
    rules, vocabulary = list(rules), dict(vocabulary)
    Rules(rules), Vocabulary(vocabulary)  # bad ones fail here
    rows, source, schema, named = carried(df, id_col, url_col, carry or [])
    keep = [f"k{i}" for i in range(len(named))]
    names = ["id", "host", "path", "rule", "verdict", "score", "terms"]

    def judge(batches):
        import pyarrow as pa
        by_rule, words = Rules(rules), Vocabulary(vocabulary)
        kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.string())]
        for whole in batches:
            for b in text_batches(whole, ["text"]):
                out = []
                for url in b.column("text").to_pylist():
                    host, path = host_path(url)
                    hits = words.hits(lowered(url or ""))
                    weight = sum(hits.values())
                    rule, verdict = by_rule.match(host, path) or (None, BLOCK if weight >= limit else ALLOW)
                    out.append((host, path, rule, verdict, weight, sorted(hits)))
                cols = list(zip(*out, strict=True)) or [()] * len(kinds)
                yield pa.RecordBatch.from_arrays([b.column("id"), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                                  *[b.column(c) for c in source]], names=[*names, *keep])

    return rows.mapInArrow(judge, "id long, host string, path string, rule string, verdict string, score long, terms array<string>" + schema).select(
        *names, *named)


def op12_url_filter(spark, sf_dir: str) -> DataFrame:
    """All page URLs judged by the rules, else by the vocabulary."""
    return judge_urls(read(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id").drop("terms")


_A_Z = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _oracle() -> str:
    weight = " + ".join(f"CASE WHEN regexp_matches(low, '(^|[^a-z0-9]){re.escape(t)}($|[^a-z0-9])') THEN {w} ELSE 0 END" for t, w in VOCABULARY.items())
    longest = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    fits = [f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN" for h, p, _ in longest]
    rule = " ".join(f"{f} '{h}{p}'" for f, (h, p, _) in zip(fits, longest, strict=True))
    verdict = " ".join(f"{f} '{v}'" for f, (_, _, v) in zip(fits, longest, strict=True))
    return f"""
WITH u AS (SELECT page_id, translate(coalesce(url, ''), {_A_Z}) AS low,
                  CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, low, rest, regexp_extract(rest, '^[^/?#]*') AS given FROM u),
p AS (SELECT page_id, translate(given, {_A_Z}) AS host, regexp_extract(substr(rest, length(given) + 1), '^[^?#]*') AS path,
             CAST({weight} AS BIGINT) AS score FROM h)
SELECT page_id, host, path, CASE {rule} END AS rule,
       CASE {verdict} WHEN score >= {LIMIT} THEN '{BLOCK}' ELSE '{ALLOW}' END AS verdict, score
FROM p"""


OP12_SQL = _oracle()
