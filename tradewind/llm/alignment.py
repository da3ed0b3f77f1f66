"""Alignment of two tokenizers by galloping intersection of their token ends.

Both tokenizers cut the same bytes; where tokens of both end, the text falls into
groups, and within a group every token of one is linked with every token of the
other. The shorter list of ends drives an exponential, then binary search into
the longer; a common end's indices in the two lists close a group, and their
differences to the previous common end are its ranges of tokens.

Neither tokenizer joins anything across a single space between words, so texts
are cut there, and each distinct chunk is encoded and aligned once a worker.
Slices of documents number their id pairs: a document carries its pairs' numbers
and how often it links them, and a slice lists its pairs with how many of its
documents hold them. Only these lists are shuffled to be counted over the corpus;
their counts meet the slice's documents again in a cogroup, a few MB a slice.
"""
from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
from functools import cache

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import materialize, read, text_batches

BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

SLICE = 1_000_000  # bytes of text whose id pairs are numbered together
KNOWN = 100_000    # chunks a worker remembers
WIDE = 1024        # links of a group that are listed one by one; of a wider group, id pairs with their number

#: A single space before a visible character of which all engines agree that it
#: is no white space.
_CUT = re.compile("(?<! ) (?=[!-~\u00a1-\u052f])")
#: Chunks that may stand one behind another in one text, of code points whose
#: class is the same in all engines.
_PLAIN = re.compile(" [!-~\u00a1-\u052f](?:[\t\n -~\u00a1-\u052f]*[!-~\u00a1-\u052f])?")


def gallop(short: np.ndarray, long: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Index in ``long`` of each value of ``short``, -1 if it is not there. The
    value of ``short[i]`` is looked for in the ascending stretch
    ``long[start[i]:stop[i]]``: steps that double bracket it, then the bracket is
    halved. All values take their steps together."""
    low, step = start.copy(), 1
    high = np.minimum(start + 1, stop)  # long[high - 1] is looked at next
    going = np.flatnonzero(low < stop)
    while len(going):
        going = going[long[high[going] - 1] < short[going]]
        low[going] = high[going]
        step *= 2
        high[going] = np.minimum(high[going] + step, stop[going])
        going = going[low[going] < stop[going]]
    going = np.flatnonzero(low < high)
    while len(going):
        middle = (low[going] + high[going]) // 2
        less = long[middle] < short[going]
        low[going[less]] = middle[less] + 1
        high[going[~less]] = middle[~less]
        going = going[low[going] < high[going]]
    found = low < stop
    found[found] = long[low[found]] == short[found]
    return np.where(found, low, -1)


def common_ends(ends_a: np.ndarray, stop_a: np.ndarray, ends_b: np.ndarray, stop_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices (in ``ends_a``, in ``ends_b``) of the ends that both hold. The
    lists are cut at ``stop_a`` and ``stop_b`` into those of one text after
    another; in each text the shorter list is looked up in the longer."""
    start_a, start_b = np.r_[0, stop_a[:-1]], np.r_[0, stop_b[:-1]]
    a_drives = stop_a - start_a <= stop_b - start_b
    out_a, out_b = [], []
    for drives, start, stop, ends, start2, stop2, ends2 in ((a_drives, start_a, stop_a, ends_a, start_b, stop_b, ends_b),
                                                            (~a_drives, start_b, stop_b, ends_b, start_a, stop_a, ends_a)):
        at = _ranges(start[drives], stop[drives])
        size = (stop - start)[drives]
        hit = gallop(ends[at], ends2, np.repeat(start2[drives], size), np.repeat(stop2[drives], size))
        at, hit = at[hit >= 0], hit[hit >= 0]
        out_a.append(at if ends is ends_a else hit)
        out_b.append(hit if ends is ends_a else at)
    return np.sort(np.concatenate(out_a)), np.sort(np.concatenate(out_b))


def byte_level_bytes(token: str) -> bytes:
    """The bytes that a token of a byte-level vocabulary spells: printable
    Latin-1 as itself, the other bytes in order from U+0100."""
    return bytes(map(_byte_alphabet().__getitem__, token))


@cache
def _byte_alphabet() -> dict[str, int]:
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in set(kept)]
    return {chr(b): b for b in kept} | {chr(0x100 + i): b for i, b in enumerate(moved)}


class Tokenizers:
    """``a(texts)`` and ``b(texts)``: ids of texts that begin with a space; the
    second tokenizer puts that space itself. ``bytes_a``, ``bytes_b``: of each id.
    ``plain_a(text)``, or None: the ids of a long text of plain chunks, for a
    byte-level vocabulary numbered in the order of its merges (a rank is an id)."""

    def __init__(self, byte_level: str, pieces: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        import sentencepiece
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(byte_level)
        tok.encode_special_tokens = True
        special = {i: t.content.encode() for i, t in tok.get_added_tokens_decoder().items()}
        self.bytes_a = [special[i] if i in special else byte_level_bytes(tok.id_to_token(i)) for i in range(tok.get_vocab_size())]
        sp = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.bytes_b = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in ((i, sp.id_to_piece(i)) for i in range(sp.get_piece_size()))]
        self.a = lambda texts: [e.ids for e in tok.encode_batch_fast(texts, add_special_tokens=False)]
        self.b = lambda texts: sp.encode([t[1:] for t in texts], num_threads=1)
        self.size_a, self.size_b = (np.array([len(t) for t in tokens], dtype=np.int64) for tokens in (self.bytes_a, self.bytes_b))
        self.plain_a = self._by_rank(byte_level, set(special)) if self.size_a.all() else None
        # What a group spells: an id and what stands behind it; behind a chunk's last, \0.
        ids_a, ids_b = (list(map(str, range(len(tokens)))) for tokens in (self.bytes_a, self.bytes_b))
        self.pieces = [i + end for ids, ends in ((ids_a, ",|"), (ids_b, ",;\0")) for end in ends for i in ids]
        # Chunks are pieces of their own unless a piece holds a space behind another character.
        self.separable = not any(re.search(b"[^ ] ", p) for p in self.bytes_b)


    def _by_rank(self, byte_level: str, special: set[int]):
        import tiktoken
        with open(byte_level, encoding="utf-8") as f:
            given = json.load(f)
        level, merges = given.get("pre_tokenizer") or {}, given["model"].get("merges", [])
        merged = [byte_level_bytes("".join(m.split(" ") if isinstance(m, str) else m)) for m in merges]
        plain = [i for i in range(len(self.bytes_a)) if i not in special]
        if (level.get("type"), level.get("add_prefix_space"), given.get("normalizer")) != ("ByteLevel", False, None) \
                or [self.bytes_a[i] for i in plain[256:]] != merged or plain != list(range(len(plain))):
            return None
        ranks = {self.bytes_a[i]: i for i in plain}
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class _Index(dict):
    """Number of each chunk, in order of first sight."""

    def __missing__(self, chunk: str) -> int:
        self[chunk] = n = len(self)
        return n


def cut(text: str) -> list[str]:
    """The chunks of a text that begins with a space."""
    try:
        text.encode("latin-1")
        every = "  " not in text and " \n" not in text and text[-1] != " " and text.replace("\n", "").isprintable()
    except UnicodeEncodeError:
        every = False
    if every:  # every space is one to cut at
        return text.replace(" ", "\0 ").split("\0")[1:]
    if "\0" in text:
        return [text]
    chunks = _CUT.sub("\0 ", text).split("\0")
    return chunks if chunks[0] else chunks[1:]


class Aligner:
    """Alignment of texts, chunk by chunk; chunks met before are known."""

    def __init__(self, byte_level: str = BYTE_LEVEL, pieces: str = PIECES, most: int = KNOWN):
        self.tok, self.most = Tokenizers(byte_level, pieces), most
        self.forget()

    def forget(self):
        self.index = _Index()
        none = np.zeros(0, dtype=np.int64)
        self.counts = np.zeros((0, 4), dtype=np.int64)  # n_a, n_b, n_groups, n_links
        self.whole = np.zeros(0, dtype=bool)            # both tokenizers spell the chunk
        self.spelled: list[str] = []                    # its groups
        self.link_pair, self.link_n, self.link_start, self.link_end = none, none, none, none

    def _plain_tokens(self, chunks: list[str]):
        """Ids of plain chunks and where each chunk's end, for both tokenizers;
        None if one does not spell them."""
        tok, text = self.tok, "".join(chunks)
        a, of_b = np.array(tok.plain_a(text), dtype=np.int64), tok.b(chunks)
        b = np.array(list(itertools.chain.from_iterable(of_b)), dtype=np.int64)
        raw = text.encode()
        if not b"".join(map(tok.bytes_a.__getitem__, a.tolist())) == raw == b"".join(map(tok.bytes_b.__getitem__, b.tolist())):
            return None
        long = len(raw) != len(text)
        ends = np.cumsum([len(c.encode()) for c in chunks] if long else [len(c) for c in chunks])
        return (a, np.searchsorted(np.cumsum(tok.size_a[a]), ends, "right"), b, np.cumsum([len(x) for x in of_b]), np.ones(len(chunks), dtype=bool))

    def _tokens(self, chunks: list[str]):
        """The same for any chunks, and whether both spell the chunk; one that is
        not spelled has no ids."""
        tok = self.tok
        a, b = tok.a(chunks), tok.b(chunks)
        whole = [b"".join(map(tok.bytes_a.__getitem__, x)) == c.encode("utf-8", "surrogatepass") == b"".join(map(tok.bytes_b.__getitem__, y))
                 for c, x, y in zip(chunks, a, b, strict=True)]
        flat = []
        for ids in (a, b):
            ids = [x if w else [] for x, w in zip(ids, whole, strict=True)]
            flat += [np.array(list(itertools.chain.from_iterable(ids)), dtype=np.int64), np.cumsum([len(x) for x in ids])]
        return (*flat, np.array(whole, dtype=bool))

    def _learn(self, chunks: list[str]) -> None:
        plain = [self.tok.plain_a is not None and self.tok.separable and _PLAIN.fullmatch(c) is not None for c in chunks]
        got = self._plain_tokens([c for c, p in zip(chunks, plain, strict=True) if p]) if any(plain) else None
        if got is None:
            plain = [False] * len(chunks)
        order = [i for i, p in enumerate(plain) if p] + [i for i, p in enumerate(plain) if not p]
        parts = [got] if got else []
        if not all(plain):
            parts.append(self._tokens([chunks[i] for i in order[sum(plain):]]))
        a, stop_a, b, stop_b, whole = parts[0]
        for a2, stop_a2, b2, stop_b2, whole2 in parts[1:]:
            stop_a, stop_b, whole = np.r_[stop_a, stop_a2 + len(a)], np.r_[stop_b, stop_b2 + len(b)], np.r_[whole, whole2]
            a, b = np.r_[a, a2], np.r_[b, b2]
        place = np.empty(len(chunks), dtype=np.int64)  # the chunks' numbers follow their order
        place[order] = np.arange(len(chunks))

        ends_a, ends_b = np.cumsum(self.tok.size_a[a]), np.cumsum(self.tok.size_b[b])
        last_a, last_b = common_ends(ends_a, stop_a, ends_b, stop_b)
        first_a, first_b = np.r_[0, last_a[:-1] + 1][:len(last_a)], np.r_[0, last_b[:-1] + 1][:len(last_b)]
        n_a, n_b = last_a + 1 - first_a, last_b + 1 - first_b
        group_end = np.searchsorted(last_a, stop_a)  # every chunk ends in a common end
        links = n_a * n_b

        # What the chunks spell: group by group the first, then the second ids, the
        # last of either and of the chunk marked.
        total_a, total_b = len(self.tok.bytes_a), len(self.tok.bytes_b)
        piece = np.empty(len(a) + len(b), dtype=np.int64)
        mark_a, mark_b = np.zeros(len(a), dtype=np.int64), np.zeros(len(b), dtype=np.int64)
        mark_a[last_a], mark_b[last_b] = total_a, total_b
        mark_b[stop_b[whole] - 1] = 2 * total_b
        piece[np.arange(len(a)) + np.repeat(first_b, n_a)] = a + mark_a
        piece[np.arange(len(b)) + np.repeat(last_a + 1, n_b)] = 2 * total_a + b + mark_b
        spelled = iter("".join(map(self.tok.pieces.__getitem__, piece.tolist())).split("\0"))
        spelled = [next(spelled) if w else "" for w in whole.tolist()]

        # Links: each first id with every second id of its group.
        wide = links > WIDE
        of = np.repeat(np.arange(len(links)), np.where(wide, 0, n_a))  # the group of each first token
        at_a = _ranges(np.where(wide, 0, first_a), np.where(wide, 0, last_a + 1))
        left = np.repeat(at_a, n_b[of])
        right = _ranges(first_b[of], last_b[of] + 1)
        pair, times, group = a[left] << 32 | b[right], np.ones(len(left), dtype=np.int64), np.repeat(of, n_b[of])
        for g in np.flatnonzero(wide).tolist():
            ids_a, m = np.unique(a[first_a[g]:last_a[g] + 1], return_counts=True)
            ids_b, n = np.unique(b[first_b[g]:last_b[g] + 1], return_counts=True)
            pair = np.r_[pair, (ids_a[:, None] << 32 | ids_b[None, :]).ravel()]
            times = np.r_[times, (m[:, None] * n[None, :]).ravel()]
            group = np.r_[group, np.full(len(ids_a) * len(ids_b), g)]
        if wide.any():
            by_group = np.argsort(group, kind="stable")
            pair, times, group = pair[by_group], times[by_group], group[by_group]
        link_end = np.searchsorted(group, group_end)
        counts = np.stack([np.diff(stop_a, prepend=0), np.diff(stop_b, prepend=0), np.diff(group_end, prepend=0), _sums(links, group_end)], axis=1)

        # Into the order in which the chunks are numbered.
        start = np.r_[0, link_end[:-1]][place]
        moved, end = _ranges(start, link_end[place]), len(self.link_pair) + np.cumsum(link_end[place] - start)
        self.link_start, self.link_end = np.r_[self.link_start, len(self.link_pair), end[:-1]], np.r_[self.link_end, end]
        self.link_pair, self.link_n = np.r_[self.link_pair, pair[moved]], np.r_[self.link_n, times[moved]]
        self.counts = np.concatenate([self.counts, counts[place]])
        self.whole = np.r_[self.whole, whole[place]]
        self.spelled += [spelled[i] for i in place.tolist()]

    def chunks(self, texts: list[str | None]) -> list[np.ndarray]:
        """Chunk numbers of each text; none for a text without tokens."""
        if len(self.index) >= self.most:
            self.forget()
        known, number = len(self.index), self.index.__getitem__
        split = [[] if not t else cut(" " + t) if self.tok.separable else [" " + t] for t in texts]
        out = [np.fromiter(map(number, c), dtype=np.int64, count=len(c)) for c in split]
        if len(self.index) > known:
            self._learn(list(itertools.islice(self.index, known, None)))
        return [c if self.whole[c].all() else c[:0] for c in out]


def _ranges(starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """All integers of the ranges, one range after another."""
    size = stops - starts
    ends = np.cumsum(size)
    return np.repeat(starts - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


def _distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, ascending."""
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]][:len(values)]]


def _counted(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, ascending, and the sum of each one's weights."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][:len(keys)])
    return keys[first], np.add.reduceat(weights[order], first) if len(first) else weights[:0]


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, ascending, and each value's place among them."""
    distinct = _distinct(values)
    return distinct, np.searchsorted(distinct, values)


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches of ``values`` that end at ``ends``."""
    total = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(values, dtype=np.int64)])[ends]
    return np.diff(total, prepend=0)


@cache
def _aligner(byte_level: str, pieces: str) -> Aligner:
    return Aligner(byte_level, pieces)


_ROWS = "slice long, id long, counts array<long>, groups string, pairs array<int>, times array<long>, at int, pair long, n int"


def slice_of(aligner: Aligner, texts: list[str | None], digests: bool) -> dict:
    """Per text ``counts`` (a row of n_a, n_b, n_groups, n_links), ``groups``, and
    where its ``pairs`` and ``times`` end; per id pair ``pair`` and ``n``, the
    texts that hold it."""
    order = aligner.chunks(texts)
    flat = np.concatenate([np.zeros(0, dtype=np.int64), *order])
    end = np.cumsum([len(c) for c in order]).astype(np.int64)
    counts = np.stack([_sums(aligner.counts[flat, k], end) for k in range(4)], axis=1)
    spelled = [";".join(map(aligner.spelled.__getitem__, c.tolist())) for c in order]
    if digests:
        spelled = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in spelled]
    # Distinct (text, chunk) and how often, then their links, then distinct (text, pair).
    base = max(1, len(aligner.spelled))
    held, often = _counted(np.repeat(np.arange(len(texts)), np.diff(end, prepend=0)) * base + flat, np.ones(len(flat), dtype=np.int64))
    doc, chunk = held // base, held % base
    start, stop = aligner.link_start[chunk], aligner.link_end[chunk]
    links = _ranges(start, stop)
    pair, link = _numbered(aligner.link_pair[links])
    m = max(1, len(pair))
    both, times = _counted(np.repeat(doc, stop - start) * m + link, aligner.link_n[links] * np.repeat(often, stop - start))
    return {"counts": counts, "groups": spelled, "pairs": both % m, "times": times, "end": np.searchsorted(both, (np.arange(len(texts)) + 1) * m),
            "pair": pair, "n": np.bincount(both % m, minlength=len(pair))}


def align(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_level: str = BYTE_LEVEL, pieces: str = PIECES,
          digests: bool = False) -> DataFrame:
    """Per row ``id``, ``n_a``, ``n_b`` (tokens of the byte-level and of the piece
    tokenizer over a space and the text), ``n_groups``, ``n_links`` (linked token
    occurrences), ``n_best`` (links whose id pair is held by as many rows as any
    pair of its first id), ``count_sum`` (over the links, rows that hold their id
    pair) and ``groups`` (``a1,a2|b1;a3|b2,b3``, or with ``digests`` its SHA-256
    in hex).

    A text that is null or empty, or that one of the tokenizers does not spell
    byte for byte, has no tokens: zeros and an empty ``groups``. Repeated rows
    count as documents of their own and null ids are answered like any others;
    an empty table gives an empty result. The number of id pairs grows with the
    corpus, so pairs are counted and joined by shuffles whose size Spark knows."""
    def encode(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        aligner, number = _aligner(byte_level, pieces), TaskContext.get().partitionId() << 32
        names = ["slice", "id", "counts", "groups", "pairs", "times", "at", "pair", "n"]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int32(), pa.int64(), pa.int32()]
        for whole in batches:
            for b in text_batches(whole, ["text"], SLICE):
                got = slice_of(aligner, b.column("text").to_pylist(), digests)
                docs, pairs, ends = b.num_rows, len(got["pair"]), np.r_[0, got["end"]].astype(np.int32)
                lists = [pa.ListArray.from_arrays(np.arange(0, 4 * docs + 1, 4, dtype=np.int32), pa.array(got["counts"].ravel())),
                         pa.array(got["groups"], pa.string()),
                         pa.ListArray.from_arrays(ends, pa.array(got["pairs"], pa.int32())), pa.ListArray.from_arrays(ends, pa.array(got["times"]))]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(docs, number)), b.column("id"), *lists, *[pa.nulls(docs, k) for k in kinds[6:]]], names=names)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(pairs, number)), *[pa.nulls(pairs, k) for k in kinds[1:6]], pa.array(np.arange(pairs), pa.int32()),
                                                  pa.array(got["pair"]), pa.array(got["n"], pa.int32())], names=names)
                number += 1

    rows = materialize(df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(encode, _ROWS), "aligned")
    docs = rows.where("pair is null").select("slice", "id", "counts", "groups", "pairs", "times")
    held = rows.where("pair is not null").select("slice", "at", "pair", "n")
    count = materialize(held.groupBy("pair").agg(F.sum("n").alias("count")), "pairs")
    first = F.shiftright("pair", 32).alias("a")
    most = count.groupBy(first).agg(F.max("count").alias("most"))
    known = count.select("pair", "count", first).join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).cast("long").alias("best"))
    back = held.join(known, "pair").select(F.col("slice").alias("of"), "at", "count", "best")

    def total(of, counted):
        import pyarrow as pa
        import pyarrow.compute as pc
        _aligner.cache_clear()  # a worker that has encoded keeps no chunks now
        of, counted = of.combine_chunks(), counted.combine_chunks()
        at = counted.column("at").to_numpy()
        values = []
        for c in ("best", "count"):
            by_number = np.zeros(len(at), dtype=np.int64)
            by_number[at] = counted.column(c).to_numpy()
            values.append(by_number)
        pairs, times, counts = (of.column(c).combine_chunks() for c in ("pairs", "times", "counts"))
        number, often = (x.flatten().to_numpy(zero_copy_only=False) for x in (pairs, times))
        end = np.cumsum(pc.list_value_length(pairs).to_numpy(zero_copy_only=False)).astype(np.int64)
        sums = [_sums(often * v[number], end) for v in values]
        four = counts.flatten().to_numpy(zero_copy_only=False).reshape(-1, 4)
        return pa.table([of.column("id"), *[pa.array(np.ascontiguousarray(c)) for c in (*four.T, *sums)], of.column("groups")],
                        names=["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])

    return docs.groupBy("slice").cogroup(back.groupBy("of")).applyInArrow(
        total, "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")


def op13_alignment(spark, sf_dir: str) -> DataFrame:
    """All documents aligned between the two public tokenizers."""
    out = align(read(spark, sf_dir, "documents"), digests=True)
    return out.withColumnsRenamed({"id": "doc_id", "groups": "groups_sha256"})
