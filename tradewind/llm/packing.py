"""Packing by cutting-stock column generation.

Every document's tokens (and an end token) are cut into whole sequences and a
remainder. Only the histogram of piece lengths reaches the driver, in classes of
one token up to ``FINE`` tokens and of ``GRAIN`` tokens beyond: at most
``FINE + max_len / GRAIN`` counts, whatever the input. A linear program over
patterns (multisets of classes that fit a sequence) covers the counts; a
knapsack dynamic program prices new patterns, a few at a time, until none helps.
Patterns are used a whole number of times, and what rounding leaves over is
packed first-fit decreasing. Each pattern becomes ranges of ranks within its
classes, and each piece, ranked within its class, finds its sequence by
arithmetic. Token ids never move.
"""
from __future__ import annotations

import json
import os
import zlib
from functools import cache

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewind.llm.chunks import Chunks, cut
from tradewind.llm.common import materialize, read, text_batches

MAX_LEN = 1024
FINE = 64      # lengths up to here are classes of their own
GRAIN = 4      # tokens a longer class spans
COLUMNS = 24   # patterns added by a pricing
STALL = 20     # pricings without a gain that end the program
GAP = 0.002   # stop when the program is this close to its bound
END = 0        # id after each document
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@cache
def _encoder(path: str):
    """Per worker: texts -> their ids as int32 arrays."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    special = [t.content for t in tok.get_added_tokens_decoder().values()]

    def alone(texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.int32) for e in tok.encode_batch_fast(texts, add_special_tokens=False)]

    # A space and letters are one match of the byte-level pattern, so such chunks
    # are encoded as one text, by the same vocabulary as ranks.
    by_rank, sizes = _by_rank(path, tok)

    def encode(chunks: list[str]) -> list[np.ndarray]:
        out = [None] * len(chunks)
        words = [i for i, c in enumerate(chunks) if c[:1] == " " and c[1:].isalpha()] if by_rank else []
        if words:
            text = "".join([chunks[i] for i in words])
            ids = np.array(by_rank(text), dtype=np.int32)
            ends = np.cumsum([len(chunks[i]) if text.isascii() else len(chunks[i].encode()) for i in words])
            stops = np.searchsorted(np.cumsum(sizes[ids]), ends, "right").tolist()
            for i, a, b in zip(words, [0, *stops], stops, strict=False):
                out[i] = ids[a:b]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, ids in zip(rest, alone([chunks[i] for i in rest]), strict=True):
            out[i] = ids
        return out

    known = Chunks(encode)

    def ids(texts: list[str]) -> list[np.ndarray]:
        parts = [None if any(s in t for s in special) else cut(t) for t in texts]
        quick = iter(known.ids([p for p in parts if p is not None]))
        whole = iter(alone([t for t, p in zip(texts, parts, strict=True) if p is None]))
        return [next(whole if p is None else quick) for p in parts]

    return ids


def _by_rank(path: str, tok):
    """An encoder of plain words and the bytes of each id, if the tokenizer is
    byte-level with nothing before it and numbers its tokens in the order of its
    merges, so that a rank is an id; else None."""
    import tiktoken
    with open(path, encoding="utf-8") as f:
        given = json.load(f)
    level, merges = given.get("pre_tokenizer") or {}, given["model"].get("merges") or []
    if (level.get("type"), level.get("add_prefix_space"), given.get("normalizer")) != ("ByteLevel", False, None):
        return None, None
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # spelled as themselves; the others from U+0100 on
    spelled = {chr(b): b for b in kept} | {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in set(kept))}
    tokens = [bytes(spelled[c] for c in tok.id_to_token(i)) for i in range(256 + len(merges))]
    if tokens[256:] != [bytes(spelled[c] for c in "".join(m.split(" ") if isinstance(m, str) else m)) for m in merges]:
        return None, None
    ranks = {t: i for i, t in enumerate(tokens)}
    quick = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return quick.encode_ordinary, np.array([len(t) for t in tokens], dtype=np.int64)


def size_class(n: int, max_len: int) -> int:
    """The length that a piece of ``n`` tokens counts with."""
    return n if n <= FINE else min(max_len, -(-n // GRAIN) * GRAIN)


def token_pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER,
                 max_len: int = MAX_LEN, keep_ids: bool = False) -> DataFrame:
    """Pieces of at most ``max_len`` ids: ``id``, ``start``, ``length``,
    ``ids_crc32``, ``doc_tokens``, ``class`` (the length that its class counts
    with), and ``part``, ``idx`` (a number within its class and task); with ``keep_ids`` also ``ids`` (binary).
    A null text is empty and so is its end token alone."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        part, encode = TaskContext.get().partitionId(), _encoder(tokenizer)
        count = np.zeros(max_len + 1, dtype=np.int64)
        names = ["id", "start", "length", "ids_crc32", "doc_tokens", "class", "part", "idx"] + ["ids"] * keep_ids
        kinds = [pa.int64()] * 5 + [pa.int32(), pa.int32(), pa.int64()] + [pa.binary()] * keep_ids
        for whole in batches:
            for b in text_batches(whole, ["text"], 2_000_000):
                rows = []
                for rid, ids in zip(b.column("id").to_pylist(), encode([t or "" for t in b.column("text").to_pylist()]), strict=True):
                    ids = np.append(ids, END).astype("<u4").tobytes()
                    n = len(ids) // 4
                    for at in range(0, n, max_len):
                        piece = ids[4 * at:4 * (at + max_len)]
                        k = size_class(len(piece) // 4, max_len)
                        rows.append((rid, at, len(piece) // 4, zlib.crc32(piece), n, k, part, int(count[k])) + (piece,) * keep_ids)
                        count[k] += 1
                cols = list(zip(*rows, strict=True)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, start long, length long, ids_crc32 long, doc_tokens long, class int, part int, idx long"
                                + ", ids binary" * keep_ids)


def _price(value: np.ndarray, sizes: np.ndarray, room: int, most: int) -> tuple[float, list[np.ndarray]]:
    """Unbounded knapsack: the value of the best pattern that fits ``room``, and
    up to ``most`` patterns worth more than 1, best first: the best one around
    each size."""
    best, last = np.zeros(room + 1), np.full(room + 1, -1)
    fits = np.searchsorted(sizes, np.arange(room + 1), "right")
    for c in range(1, room + 1):
        best[c], last[c] = best[c - 1], -1
        if fits[c]:
            v = value[:fits[c]] + best[c - sizes[:fits[c]]]
            i = int(v.argmax())
            if v[i] > best[c]:
                best[c], last[c] = v[i], i
    worth = value + best[room - sizes]
    out = {}
    for i in np.argsort(-worth, kind="stable")[:most]:
        if worth[i] <= 1 + 1e-9:
            break
        pattern, c = np.zeros(len(sizes)), int(room - sizes[i])
        pattern[i] = 1
        while c > 0:
            if last[c] < 0:
                c -= 1
            else:
                pattern[last[c]] += 1
                c -= sizes[last[c]]
        out[pattern.tobytes()] = pattern
    return float(best[room]), list(out.values())


def _rest(sizes: np.ndarray, counts: np.ndarray, room: int) -> dict[tuple, int]:
    """First-fit decreasing on counts of sizes: pattern -> times. Bins are
    grouped by free room, so many equal items cost one step."""
    bins: dict[int, list] = {}  # free room -> patterns
    for i in range(len(sizes) - 1, -1, -1):
        s, n = int(sizes[i]), int(counts[i])
        while n:
            fits = [f for f in bins if f >= s and bins[f]]
            free = min(fits) if fits else room
            pattern = bins[free].pop() if fits else {}
            k = min(n, free // s)
            n -= k
            bins.setdefault(free - k * s, []).append({**pattern, i: k})
    out: dict[tuple, int] = {}
    for patterns in bins.values():
        for p in patterns:
            key = tuple(sorted(p.items(), reverse=True))
            out[key] = out.get(key, 0) + 1
    return out


def _sharper(inverse: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """A step of Newton's method towards the inverse of the basis, whose patterns are rows."""
    return 2 * inverse - np.einsum("ij,jk->ik", inverse, np.einsum("ji,jk->ik", basis, inverse))


def column_generation(sizes: np.ndarray, counts: np.ndarray, room: int, gap: float = GAP) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) and how often to use them: min sum(x), patterns' items
    equal to ``counts``; ``sizes`` ascend. Revised simplex from the patterns of
    one size each over a pool of patterns, at first those of first-fit
    decreasing. When no pattern of the pool improves, pricing adds new ones. Ends
    when there are none, within ``gap`` of the bound that the duals prove, or
    when ``STALL`` pricings together gain less than a tenth of ``gap``."""
    m, given = len(sizes), counts
    counts = counts + 1e-5 * (1 + np.arange(m) * 0.6180339887 % 1)  # no two ratios tie, so no pivot cycles
    basis = np.diag((room // sizes).astype(float))  # basic patterns are rows
    inverse, x = np.diag(1 / np.diag(basis)), counts / np.diag(basis)
    bound = (sizes * counts).sum() / room
    pool = np.zeros((0, m))
    new = [np.bincount([i for i, _ in p], weights=[k for _, k in p], minlength=m) for p in _rest(sizes, np.rint(counts).astype(np.int64), room)]
    pivots, mark = 0, []
    for _ in range(20 * m):  # pricings, far more than are needed
        pool = np.concatenate([pool, *[p[None] for p in new]])
        for _ in range(4 * m):
            dual = inverse.sum(axis=0)
            worth = pool @ dual
            enter = int(worth.argmax()) if len(pool) else -1
            if enter < 0 or worth[enter] <= 1 + 1e-7 or x.sum() <= bound * (1 + gap):
                break
            step = inverse @ pool[enter]
            able = step > 1e-9
            ratio = np.where(able, x / np.where(able, step, 1), np.inf)
            leave = int(ratio.argmin())
            basis[leave] = pool[enter]
            pivots += 1
            x = np.maximum(0, x - ratio[leave] * step)
            x[leave] = ratio[leave]
            row = inverse[leave] / step[leave]
            inverse -= np.outer(step, row)
            inverse[leave] = row
            if pivots % 256 == 0:  # errors add up
                inverse = _sharper(inverse, basis)
                x = np.maximum(0, inverse @ counts)
        mark.append(x.sum())
        if x.sum() <= bound * (1 + gap) or len(mark) > STALL and mark[-1 - STALL] - mark[-1] < gap / 10 * bound:
            break
        value, new = _price(inverse.sum(axis=0), sizes, room, COLUMNS)
        bound = max(bound, x.sum() / max(value, 1.0))
        if not new or x.sum() <= bound * (1 + gap):
            break
    return basis, np.maximum(0, _sharper(inverse, basis) @ given)


def plan(histogram: dict[int, int], room: int, gap: float = GAP) -> list[tuple[int, int, int, int, int, int]]:
    """Ranges ``(class, lo, hi, sequence, each, slot)``: the pieces of a class
    ranked lo..hi-1 fill ``each`` slots from ``slot`` on in one sequence after
    another from ``sequence`` on. Whole sequences (class = room) come first."""
    out, at, used = [], 0, {}

    def use(items, times):
        nonlocal at
        slot = 0
        for size, each in items:
            lo = used.get(size, 0)
            out.append((size, lo, lo + times * each, at, each, slot))
            used[size] = lo + times * each
            slot += each
        at += times

    if histogram.get(room):
        use([(room, 1)], histogram[room])
    sizes = np.array(sorted(s for s, n in histogram.items() if s < room and n), dtype=np.int64)
    if len(sizes):
        left = np.array([histogram[int(s)] for s in sizes], dtype=np.int64)
        patterns, x = column_generation(sizes, left.astype(float), room, gap)
        for p, times in zip(np.rint(patterns).astype(np.int64), x, strict=True):
            most = min((int(left[i] // p[i]) for i in np.flatnonzero(p)), default=0)
            times = min(int(np.floor(times + 1e-6)), most)
            if times:
                use([(int(sizes[i]), int(p[i])) for i in np.flatnonzero(p)[::-1]], times)
                left -= times * p
        for items, times in sorted(_rest(sizes, left, room).items(), reverse=True):
            use([(int(sizes[i]), k) for i, k in items], times)
    return out


def pack_pieces(pieces: DataFrame, max_len: int = MAX_LEN, gap: float = GAP) -> DataFrame:
    """``pieces`` (columns ``length``, ``class``, ``part``, ``idx`` and any
    more, whatever their names) with ``sequence_id`` and ``offset`` (gapless from 0). The input must
    be a written table, so that numbers within a task stay as they are. No
    pieces give no rows."""
    spark = pieces.sparkSession
    by_part = pieces.groupBy("class", "part").agg(F.count("*").alias("n"))
    histogram = {r["class"]: r["n"] for r in by_part.groupBy("class").agg(F.sum("n").alias("n")).collect()}
    ranges = spark.createDataFrame(plan(histogram, max_len, gap), "size int, lo long, hi long, sequence long, each long, first long")
    before = W.partitionBy("class").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = by_part.select("class", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # The given columns travel as one, whatever their names.
    own = [c for c in pieces.columns if c not in ("class", "part", "idx")]
    ranked = (pieces.select("class", "part", "idx", "length", F.struct(*own).alias("piece")).join(offsets, ["class", "part"])
              .withColumn("rank", F.col("idx") + F.col("before")))
    # A broadcast of a few entries per basic pattern and left-over bin: bounded
    # by the number of length classes, not by the input.
    r = F.broadcast(ranges)
    placed = ranked.join(r, (F.col("class") == F.col("size")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    nth = F.col("rank") - F.col("lo")
    placed = placed.select("piece", "length", (F.col("sequence") + F.floor(nth / F.col("each"))).alias("sequence_id"),
                           (F.col("first") + nth % F.col("each")).alias("slot"))
    earlier = W.partitionBy("sequence_id").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    return placed.select("piece", "sequence_id", F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset")).select(
        "piece.*", "sequence_id", "offset")


def pack_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER,
                   max_len: int = MAX_LEN, keep_ids: bool = False) -> DataFrame:
    """Tokenize, cut and pack the rows of ``df``; see ``token_pieces`` and
    ``pack_pieces``. Repeated rows and null ids are packed like any others; an empty
    table gives an empty result."""
    return pack_pieces(materialize(token_pieces(df, id_col, text_col, tokenizer, max_len, keep_ids), "pieces"), max_len)


def op9_packing(spark, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    out = pack_documents(read(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
