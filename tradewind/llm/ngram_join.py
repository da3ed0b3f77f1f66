"""Exact n-gram Jaccard join: rare-first prefix filtering with length,
positional and suffix filters, verified once per pair.

A document is the set of 64-bit hashes of its distinct 4-word shingles; equal
sets are one node (named by a 64-bit hash of the set), so copies are never
paired. Every set is ordered rare first: by the count of a shingle's slot in a
fixed-size table of counts over all documents (an upper bound of its document
frequency), then by the shingle itself. Any common order makes the join exact;
the counts only make prefixes rare. Two sets within the threshold must share a
shingle in their prefixes.

Nodes that share a prefix shingle meet in a bucket. Pairs of small buckets
pass the length, positional and suffix filters and are verified. In buckets of
``HOT`` nodes or more (groups of near copies), the nodes are first linked along
a sliding window, which joins dense groups without listing their pairs;
afterwards every pair of such a bucket whose nodes still lie in different
components passes the same filters and is verified. No pair that could join
two components is skipped.
"""
from __future__ import annotations


import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewind.llm.byte_spans import SPACE, ByteSpans, mix
from tradewind.llm.common import materialize, read, shuffle_partitions, text_batches
from tradewind.llm.graph import components

N = 4            # words in a shingle
PERCENT = 85     # linked when 100 * intersection >= PERCENT * union
SLOTS = 1 << 20  # slots of the count table: 4 MB, whatever the input
SLICES = 64      # the table moves in so many slices
HOT = 32         # nodes in a bucket from which it is linked before it is paired
WINDOW = 64      # nodes a node is compared with on each visit to a hot bucket
VISITS = 3       # hot buckets that a node visits, largest first
PARTS = 64       # hash classes of the suffix filter

def shingle_sets(texts: list[str | None], n: int = N) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text: words are runs of other
    bytes than ASCII white space, A-Z lower-cased; a text of fewer than ``n``
    words is one shingle; one without words, or null, has none."""
    raw = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    spans = ByteSpans(b" ".join(raw) + b" ")
    at = np.cumsum([0] + [len(r) + 1 for r in raw])
    start, stop = spans.runs(~SPACE[spans.data])
    words = spans.hash(start, stop)
    first = np.searchsorted(start, at)
    grams = np.zeros(len(words), dtype=np.uint64)
    steps = [np.uint64(2 * pow(3, 37 + i, 1 << 62) + 1) for i in range(n)]
    full = max(0, len(words) - n + 1)
    for i in range(n):
        grams[:full] += words[i:i + full] * steps[i]
    grams = mix(grams)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(grams[a:b - n + 1]))
        else:
            short = np.array([b - a], dtype=np.uint64)
            for i in range(a, b):
                short += words[i:i + 1] * steps[i - a]
            out.append(mix(short) if b > a else short[:0])
    return out


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """Rarest shingles of which linked sets share at least one: a partner
    holds ``ceil(percent * n / 100)`` of the set's n shingles."""
    return n - -(-percent * n // 100) + 1 if n else 0


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    common = len(a) + len(b) - len(np.union1d(a, b))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _signed(x) -> np.ndarray:
    return np.asarray(x, dtype=np.uint64).view(np.int64)


def _node(s: np.ndarray) -> int:
    return int(_signed(mix(mix(s).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(s))))[0])


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``jid``, ``text``: a null id is replaced by a hash of the text."""
    return df.select(F.coalesce(F.col(id_col).cast("long"), F.xxhash64(F.col(text_col))).alias("jid"), F.col(text_col).alias("text"))


def _nodes_and_counts(df: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """One pass: a row per document (``id``, ``text_hash``, ``n``, ``node``) and the
    task's count table in slices (``slice``, ``counts``)."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))

    def run(batches):
        import pyarrow as pa
        counts = np.zeros(SLOTS, dtype=np.uint32)
        names, kinds = ["id", "text_hash", "n", "node", "slice", "counts"], [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]

        def batch(*cols):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

        for whole in batches:
            for b in text_batches(whole, ["text"], 2_000_000):
                sets = shingle_sets(b.column("text").to_pylist(), n)
                none = [None] * len(sets)
                if sets:
                    slots = np.concatenate(sets) % np.uint64(SLOTS)
                    counts += np.bincount(slots.astype(np.int64), minlength=SLOTS).astype(np.uint32)
                yield batch(b.column("id").to_pylist(), b.column("text_hash").to_pylist(), [len(s) for s in sets],
                            [_node(s) for s in sets], none, none)
        if counts.any():
            none = [None] * SLICES
            yield batch(none, none, none, none, range(SLICES), [c.tobytes() for c in np.split(counts, SLICES)])

    out = rows.mapInArrow(run, "id long, text_hash long, n long, node long, slice int, counts binary")
    return materialize(out, "ngram-nodes")


def _count_table(rows: DataFrame) -> bytes:
    """The tasks' tables added up slice by slice; 4 MB reach the driver."""
    def add(batches):
        import pyarrow as pa
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, c in zip(b.column("slice").to_pylist(), b.column("counts").to_pylist(), strict=True):
                c = np.frombuffer(c, dtype=np.uint32).astype(np.uint64)
                sums[k] = sums[k] + c if k in sums else c
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([np.minimum(v, 2**32 - 1).astype(np.uint32).tobytes() for v in sums.values()], pa.binary())],
                                         names=["slice", "counts"])

    sliced = rows.where("slice is not null").select("slice", "counts").repartition("slice")
    got = {r["slice"]: r["counts"] for r in sliced.mapInArrow(add, "slice int, counts binary").collect()}
    return b"".join(got.get(i, b"\0" * (4 * SLOTS // SLICES)) for i in range(SLICES))


def _prefixes(df: DataFrame, id_col: str, text_col: str, n: int, percent: int, table: bytes) -> DataFrame:
    """Per node: ``n``, ``jid`` of a document with it, ``prefix`` (rarest
    shingles, rare first) and ``parts`` (shingles in each hash class)."""
    shared = df.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        import pyarrow as pa
        table = np.frombuffer(shared.value, dtype=np.uint32)
        names = ["node", "jid", "n", "prefix", "parts"]
        for whole in batches:
            for b in text_batches(whole, ["text"], 2_000_000):
                sets = shingle_sets(b.column("text").to_pylist(), n)
                rows = []
                for jid, s in zip(b.column("jid").to_pylist(), sets, strict=True):
                    if len(s):
                        seen = table[(s % np.uint64(SLOTS)).astype(np.int64)]
                        order = np.lexsort((s, seen))[:prefix_length(len(s), percent)]
                        parts = np.bincount((s >> np.uint64(58)).astype(np.int64), minlength=PARTS)
                        rows.append((_node(s), jid, len(s), _signed(s[order]), np.minimum(parts, 65535).astype(np.uint16).tobytes()))
                cols = list(zip(*rows, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                                                  pa.array(cols[3], pa.list_(pa.int64())), pa.array(cols[4], pa.binary())], names=names)

    rows = _texts(df, id_col, text_col).mapInArrow(run, "node long, jid long, n long, prefix array<long>, parts binary")
    first = [F.first(c).alias(c) for c in ("n", "prefix", "parts")]
    return materialize(rows.groupBy("node").agg(F.min("jid").alias("jid"), *first), "ngram-prefixes")


def _near(a: str, b: str, percent: int):
    """Length and positional filters on rows ``(n, pos)`` that share a prefix
    shingle at ``pos``: what remains of either set from there on must hold the
    overlap that a link needs."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    need = (100 + percent) * F.least(na - F.col(f"{a}.pos"), nb - F.col(f"{b}.pos"))
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & (need >= percent * (na + nb))


def _suffix_filter(pairs: DataFrame, per_node: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs ``(a, b)`` whose hash classes allow the overlap: sets
    share at most the smaller count of each class."""
    p = per_node.select("node", "n", "parts")
    full = (pairs.select("a", "b").distinct()
            .join(p.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("parts").alias("pa")), "a")
            .join(p.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("parts").alias("pb")), "b"))

    def run(batches):
        import pyarrow as pa
        for b in batches:
            if not b.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), dtype=np.uint16).reshape(-1, PARTS) for c in ("pa", "pb"))
            most = np.minimum(x, y).sum(axis=1, dtype=np.int64)
            # A class count at its ceiling is no bound.
            most[((x == 65535) & (y == 65535)).any(axis=1)] = 1 << 60
            ok = (100 + percent) * np.minimum(most, 1 << 40) >= percent * (b.column("na").to_numpy() + b.column("nb").to_numpy())
            yield b.select(["a", "b"]).filter(pa.array(ok))

    return full.mapInArrow(run, "a long, b long")


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs that are links, as edges; both whole sets are compared."""
    both = (pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b"))

    def run(batches):
        import pyarrow as pa
        for b in batches:
            ok = [linked(np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64), percent)
                  for x, y in zip(b.column("sa").to_pylist(), b.column("sb").to_pylist(), strict=True)]
            out = b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))
            yield pa.RecordBatch.from_arrays(out.columns, names=["u", "v"])

    return both.mapInArrow(run, "u long, v long")


def _link_hot(visits: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links along a window of each hot bucket: a node is compared with the
    ``WINDOW`` nodes before it, once per group already joined with it."""
    rows = visits.join(sets.select("node", "set"), "node").repartition(shuffle_partitions(visits.sparkSession), "tok")
    rows = rows.sortWithinPartitions("tok", F.xxhash64("node"), "node").select("tok", "node", "set")

    def run(batches):
        import pyarrow as pa
        tok, recent, edges = None, [], []
        for b in batches:
            for t, node, raw in zip(b.column("tok").to_pylist(), b.column("node").to_pylist(), b.column("set").to_pylist(), strict=True):
                if t != tok:
                    tok, recent = t, []
                s, group = np.frombuffer(raw, dtype=np.uint64), node
                joined = set()
                for other, o, g in reversed(recent):
                    if g not in joined and linked(s, o, percent):
                        edges.append((node, other))
                        joined.add(g)
                if joined:
                    group = min(joined)
                    recent = [(x, o, group if g in joined else g) for x, o, g in recent]
                recent = [*recent, (node, s, group)][-WINDOW:]
            if len(edges) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*edges, strict=True)], names=["u", "v"])
                edges = []
        cols = list(zip(*edges, strict=True)) or [(), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["u", "v"])

    return rows.mapInArrow(run, "u long, v long")


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       n: int = N, percent: int = PERCENT) -> DataFrame:
    """Every row of ``df`` as ``id``, ``n_shingles`` long, ``component_id``
    (smallest id reachable by links, its own included), ``text_hash`` (xxhash64
    of the text) and ``component`` (names the component by a node; null for a
    document without words).

    Documents without words are linked with nothing, each its own component. A
    null id keeps a row and never names a component (a component of null ids
    only has a null name). Rows that repeat an id keep their own sets and meet
    only through links. An empty table gives an empty result; columns other
    than the two named are not read.
    """
    nodes = _nodes_and_counts(df, id_col, text_col, n)
    per_node = _prefixes(df, id_col, text_col, n, percent, _count_table(nodes))

    toks = per_node.select("node", "n", F.posexplode("prefix").alias("pos", "tok"))
    bucket = W.partitionBy("tok")
    toks = toks.withColumn("size", F.count("*").over(bucket)).where("size > 1")
    toks = materialize(toks.select("tok", "node", "n", "pos", "size"), "ngram-buckets")

    small, hot = toks.where(F.col("size") < HOT), toks.where(F.col("size") >= HOT)
    pairs = (small.alias("x").join(small.alias("y"), (F.col("x.tok") == F.col("y.tok")) & (F.col("x.node") < F.col("y.node")) & _near("x", "y", percent))
             .select(F.col("x.node").alias("a"), F.col("y.node").alias("b")))
    pairs = materialize(_suffix_filter(pairs, per_node, percent), "ngram-pairs")
    visit = W.partitionBy("node").orderBy(F.desc("size"), "tok")
    visits = hot.withColumn("turn", F.row_number().over(visit)).where(F.col("turn") <= VISITS).select("tok", "node")

    need = pairs.select("a").union(pairs.select("b")).union(visits.select("node")).distinct().toDF("node")
    need = need.join(per_node.select("node", "jid"), "node")
    sets = _sets_of(df, id_col, text_col, n, need)

    edges = materialize(_verify(pairs, sets, percent).union(_link_hot(visits, sets, percent)), "ngram-links")
    comp = components(edges)

    # What the window did not join: pairs of a hot bucket in two components.
    # All but one component of a bucket are a few nodes once it is linked;
    # each such pair has a node outside the bucket's largest component.
    placed = hot.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    by_comp = placed.groupBy("tok", "comp").agg(F.count("*").alias("members"))
    main = by_comp.groupBy("tok").agg(F.max(F.struct("members", "comp")).alias("m"), F.count("*").alias("comps"))
    main = main.where("comps > 1").select("tok", F.col("m.comp").alias("main"))
    placed = materialize(placed.join(main, "tok"), "ngram-hot")
    x, y = placed.where("comp <> main").alias("x"), placed.alias("y")
    rest = x.join(y, (F.col("x.tok") == F.col("y.tok")) & (F.col("x.comp") != F.col("y.comp")) & _near("x", "y", percent))
    rest = rest.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
    more = _verify(_suffix_filter(rest, per_node, percent), sets, percent)
    more = materialize(more, "ngram-links")
    if not more.isEmpty():
        comp = components(edges.union(more))

    ids = nodes.where("slice is null").select("id", "text_hash", "n", "node")
    named = ids.where("n > 0").groupBy("node").agg(F.min("id").alias("first"))
    named = named.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    lowest = named.groupBy("comp").agg(F.min("first").alias("component_id"))
    named = named.join(lowest, "comp").select("node", "comp", "component_id")
    return (ids.join(named, "node", "left")
            .select("id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
                    "text_hash", F.col("comp").alias("component")))


def _sets_of(df: DataFrame, id_col: str, text_col: str, n: int, need: DataFrame) -> DataFrame:
    """``node``, ``set`` (sorted hashes) of the nodes in ``need(node, jid)``."""
    need = need.select(F.col("node").alias("want"), "jid")
    texts = _texts(df, id_col, text_col).join(need, "jid")

    def run(batches):
        import pyarrow as pa
        for whole in batches:
            for b in text_batches(whole, ["text"], 2_000_000):
                rows = [(w, s.tobytes()) for w, s in zip(b.column("want").to_pylist(), shingle_sets(b.column("text").to_pylist(), n), strict=True)
                        if _node(s) == w]
                cols = list(zip(*rows, strict=True)) or [(), ()]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.binary())], names=["node", "set"])

    return materialize(texts.select("want", "text").mapInArrow(run, "node long, set binary").dropDuplicates(["node"]), "ngram-sets")


def op3_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    """Exact 4-word shingle Jaccard components (0.85) over all documents."""
    out = jaccard_components(read(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")
