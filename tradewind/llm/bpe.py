"""Byte-level BPE by recursive queries.

Each task runs DuckDB in memory. A recursive query holds every new word's
tokens; a step joins its token positions to the merge table, takes the leftmost
pair of minimum rank in each word, contracts it, and goes on until no word has
a pair left. Decoding joins token positions to the vocabulary and aggregates
the tokens' bytes in order. Spark deals out the documents; chunks of text met
before keep their ids, and what those decoded to, in a table of bounded size, so
both queries run over new chunks only and a document's ids decode as the
sequence of its chunks' ids.
"""
from __future__ import annotations

import base64
import hashlib
from functools import cache

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.chunks import Chunks, cut, plain
from tradewind.llm.common import read, text_batches

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN

#: One step contracts one pair in each word; a word longer than 2^20 tokens
#: would not fit the combined key of rank and position.
_POSITIONS = 1 << 20

_START = """SELECT w.word, CASE WHEN v.id IS NULL THEN w.ids ELSE [v.id] END
  FROM words w LEFT JOIN vocab v ON v.tok = w.raw"""

ENCODE = f"""
WITH RECURSIVE enc(word, ids) AS (
  {_START}
 UNION ALL
  SELECT e.word, list_concat(list_append(e.ids[1:(best % {_POSITIONS} - 1)], (best // {_POSITIONS})::INT), e.ids[(best % {_POSITIONS} + 2):])
  FROM enc e
  JOIN (SELECT t.word, min(m.rank::BIGINT * {_POSITIONS} + t.pos) AS best
        FROM (SELECT word, unnest(ids[1:(len(ids) - 1)]) AS a, unnest(ids[2:]) AS b, unnest(range(1, len(ids))) AS pos FROM enc) t
        JOIN merges m ON m.a = t.a AND m.b = t.b
        GROUP BY t.word) x ON x.word = e.word)
SELECT word, arg_min(ids, len(ids)) AS ids FROM enc GROUP BY word ORDER BY word
"""

#: For long words: a step contracts every pair of the minimum rank, from the
#: left, where that equals contracting them one by one (no pair with the new
#: token ranks lower); else the leftmost only. Only the last state is kept.
ENCODE_LONG = f"""
WITH RECURSIVE enc(word, ids) USING KEY (word) AS (
  {_START}
 UNION
  SELECT word, list(CASE WHEN hit THEN best ELSE id END ORDER BY pos)
  FROM (SELECT *, lag(hit, 1, false) OVER (PARTITION BY word ORDER BY pos) AS taken
        FROM (SELECT *, rank IS NOT DISTINCT FROM best
                        AND (pos = first OR safe AND (row_number() OVER (PARTITION BY word, run, rank IS NOT DISTINCT FROM best ORDER BY pos)) % 2 = 1) AS hit
              FROM (SELECT *, pos - row_number() OVER (PARTITION BY word, rank IS NOT DISTINCT FROM best ORDER BY pos) AS run,
                           min(pos) FILTER (rank = best) OVER (PARTITION BY word) AS first
                    FROM (SELECT *, min(rank) OVER (PARTITION BY word) AS best
                          FROM (SELECT t.word, t.pos, t.ids[t.pos] AS id, m.rank, m.safe
                                FROM (SELECT word, ids, unnest(range(1, len(ids) + 1)) AS pos FROM enc) t
                                LEFT JOIN merges m ON m.a = t.ids[t.pos] AND m.b = t.ids[t.pos + 1]))
                    WHERE best IS NOT NULL)))
  WHERE NOT taken GROUP BY word)
SELECT word, ids FROM enc ORDER BY word
"""

LONG = 64  # bytes from which a word counts as long

#: A token's bytes are spelled as the code points from U+0100 on.
DECODE = """
SELECT seq, string_agg(v.spelled, '' ORDER BY t.pos) AS spelled FROM toks t JOIN vocab v USING (id) GROUP BY seq
"""


def merge_table(ranks: dict[bytes, int]) -> tuple[list[int], list[int], list[int]]:
    """All pairs of tokens whose bytes together are a token: left, right, rank."""
    out: tuple[list[int], list[int], list[int]] = ([], [], [])
    for tok, rank in ranks.items():
        for i in range(1, len(tok)):
            a, b = ranks.get(tok[:i]), ranks.get(tok[i:])
            if a is not None and b is not None:
                for column, value in zip(out, (a, b, rank), strict=True):
                    column.append(value)
    return out


def lowered(a: np.ndarray, b: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Tokens that are part of a pair whose rank is below their own."""
    return np.unique(np.r_[a[rank < a], b[rank < b]])


class Bpe:
    def __init__(self, ranks_path: str = RANKS, pattern: str = PATTERN):
        import duckdb
        import pyarrow as pa
        with open(ranks_path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = regex.compile(pattern)
        #: Byte pairs that stand inside some token; nothing joins any other two.
        self.joined = np.zeros((256, 256), dtype=bool)
        for t in self.ranks:
            at = np.frombuffer(t, dtype=np.uint8)
            self.joined[at[:-1], at[1:]] = True
        self.of_byte = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        a, b, rank = (np.array(c, dtype=np.int32) for c in merge_table(self.ranks))
        self._table("merges", pa.table({"a": a, "b": b, "rank": rank, "safe": ~np.isin(rank, lowered(a, b, rank))}))
        self._table("vocab", pa.table({"tok": pa.array(list(self.ranks), pa.binary()), "id": pa.array(list(self.ranks.values()), pa.int32()),
                                       "spelled": ["".join(chr(0x100 + c) for c in t) for t in self.ranks]}))
        self.known = Chunks(self._encode_chunks, self.decode)
        self.decimal = [str(i) for i in range(max(self.ranks.values()) + 1)]
        self.stand_in: dict[int, str] = {}

    def _table(self, name, rows):
        self.con.register("given", rows)
        self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.con.unregister("given")

    def _classes(self, points: list[str]) -> None:
        """Class of code points as the tiktoken library sees them: an encoding
        whose pattern is one class keeps only the code points of that class."""
        import tiktoken
        every = "".join(points)
        for kind, stand in ((r"\p{L}", "a"), (r"\p{N}", "0"), (r"\s", "\t")):
            one = tiktoken.Encoding("class", pat_str=kind, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
            self.stand_in.update({ord(c): stand for c in one.decode(one.encode_ordinary(every))})
        for c in points:
            self.stand_in.setdefault(ord(c), "!")

    def words(self, text: str) -> list[str]:
        """Matches of the pattern. Code points whose class may differ between
        regex engines are matched as a plain one of the library's class."""
        if text[text[:1] == " ":].isalpha() and plain(text):
            return [text]  # one match
        if plain(text):
            return self.pattern.findall(text)
        odd = {c for c in set(text) if not plain(c)}
        if new := [c for c in odd if ord(c) not in self.stand_in]:
            self._classes(sorted(new))
        like = text.translate({ord(c): self.stand_in[ord(c)] for c in odd})
        return [text[m.start():m.end()] for m in self.pattern.finditer(like)]

    def parts(self, raw: bytes) -> list[bytes]:
        """A long word cut where no token holds the bytes on both sides."""
        at = np.frombuffer(raw, dtype=np.uint8)
        cuts = [0, *(np.flatnonzero(~self.joined[at[:-1], at[1:]]) + 1).tolist(), len(raw)]
        return [raw[i:j] for i, j in zip(cuts, cuts[1:], strict=False)]

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word, by the recursive queries."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        cut = {r: p for r in raw if len(r) >= LONG and len(p := self.parts(r)) > 1}
        whole = [r for r in dict.fromkeys(raw) if r not in cut]
        part = sorted({p for ps in cut.values() for p in ps})
        # A word that is a token as it stands is that token; a part must be joined to become one.
        known = dict(zip(whole, self._encode(whole, whole), strict=True))
        joined = dict(zip(part, self._encode(part, [None] * len(part)), strict=True))
        return [known[r] if r in known else np.concatenate([joined[p] for p in cut[r]]) for r in raw]

    def _encode(self, raw: list[bytes], tokens: list[bytes | None]) -> list[np.ndarray]:
        """Ids of ``raw``, whose whole token, if there is one, is in ``tokens``."""
        out: list = [None] * len(raw)
        for query, size in ((ENCODE, lambda n: n < LONG), (ENCODE_LONG, lambda n: n >= LONG)):
            at = [i for i, r in enumerate(raw) if size(len(r))]
            for i, ids in zip(at, self._run(query, [raw[i] for i in at], [tokens[i] for i in at]), strict=True):
                out[i] = ids
        return out

    def _run(self, query: str, raw: list[bytes], tokens: list[bytes | None]) -> list[np.ndarray]:
        import pyarrow as pa
        if not raw:
            return []
        flat = self.of_byte[np.frombuffer(b"".join(raw), dtype=np.uint8)]
        ids = pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(r) for r in raw]), pa.int32()), pa.array(flat))
        self.con.register("words", pa.table({"word": pa.array(np.arange(len(raw)), pa.int32()), "raw": pa.array(tokens, pa.binary()), "ids": ids}))
        got = self.con.sql(query).to_arrow_table().column("ids").combine_chunks()
        self.con.unregister("words")
        flat, ends = got.flatten().to_numpy().astype(np.int32), np.diff(got.offsets.to_numpy()).cumsum().tolist()
        return [flat[i:j] for i, j in zip([0, *ends[:-1]], ends, strict=True)]

    def _encode_chunks(self, chunks: list[str]) -> list[np.ndarray]:
        split = [self.words(c) for c in chunks]
        words = sorted(set().union(*split))
        ids = dict(zip(words, self.encode_words(words), strict=True))
        return [ids[s[0]] if len(s) == 1 else np.concatenate([ids[w] for w in s]) if s else np.zeros(0, dtype=np.int32) for s in split]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        return self.known.ids([[t] if (c := cut(t)) is None else c for t in texts])

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes of each id sequence, by ordered aggregation."""
        import pyarrow as pa
        flat = np.concatenate([np.zeros(0, dtype=np.int32), *ids])
        seq = np.repeat(np.arange(len(ids), dtype=np.int32), [len(x) for x in ids])
        self.con.register("toks", pa.table({"seq": seq, "pos": np.arange(len(flat)), "id": flat}))
        got = self.con.sql(DECODE).to_arrow_table()
        self.con.unregister("toks")
        out = [b""] * len(ids)
        for i, spelled in zip(got.column("seq").to_pylist(), got.column("spelled").to_pylist(), strict=True):
            out[i] = spelled.encode("utf-16-le")[::2]  # the low bytes
        return out


@cache
def _bpe(ranks_path: str, pattern: str) -> Bpe:
    return Bpe(ranks_path, pattern)


def encode_decode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks_path: str = RANKS,
                  pattern: str = PATTERN, digests: bool = False) -> DataFrame:
    """``id``, ``ids`` array<int> and ``decoded`` binary per row; with
    ``digests`` instead ``n_tokens`` long, ``ids_sha256`` and
    ``decoded_sha256``. A null text is empty; an empty text has no ids.
    Repeated rows and null ids are answered like any others."""
    def run(batches):
        import pyarrow as pa
        bpe = _bpe(ranks_path, pattern)
        for whole in batches:
            for b in text_batches(whole, ["text"], 6_000_000):
                got = bpe.encode([t or "" for t in b.column("text").to_pylist()])
                back = bpe.known.decoded()
                if digests:
                    spelled = [" ".join(map(bpe.decimal.__getitem__, x.tolist())) for x in got]
                    cols = [pa.array([len(x) for x in got], pa.int64()), pa.array([hashlib.sha256(s.encode()).hexdigest() for s in spelled], pa.string()),
                            pa.array([hashlib.sha256(x).hexdigest() for x in back], pa.string())]
                    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
                else:
                    cols = [pa.array(got, pa.list_(pa.int32())), pa.array(back, pa.binary())]
                    names = ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays([b.column("id"), *cols], names=["id", *names])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "id long, ids array<int>, decoded binary")


def op8_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """All documents encoded by the public ranks and decoded again."""
    return encode_decode(read(spark, sf_dir, "documents"), digests=True).withColumnRenamed("id", "doc_id")
