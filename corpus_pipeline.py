"""Training-data pipeline over ``documents``: language identification, toxicity,
n-gram Jaccard deduplication, packing.

Every stage works on what the one before kept, written as Parquet and reread.
All but the last return the columns of ``documents``.
"""
from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewind.llm.common import materialize, read
from tradewind.llm.langid import UNKNOWN, fit_languages, identify
from tradewind.llm.ngram_join import jaccard_components
from tradewind.llm.packing import pack_documents
from tradewind.llm.toxicity import fit_toxicity, score

#: Mean marginal of its language below which a document has none. Four equal
#: shares would be 0.25.
LEAST_SCORE = 0.3

#: Words in a shingle and least Jaccard, in percent, of near duplicates. op3's
#: contract has its own (4 words, 85).
DEDUP_WORDS, DEDUP_PERCENT = 5, 80


def _rows(found, docs, keep):
    """The documents whose row in ``found`` meets ``keep``; the operator's own
    columns come before the carried ones, whatever their names."""
    own = len(found.columns) - len(docs.columns)
    names = [*found.columns[:own], *[f"_kept_{i}" for i in range(len(docs.columns))]]
    return found.toDF(*names).where(keep).select(*[F.col(f"_kept_{i}").alias(c) for i, c in enumerate(docs.columns)])


def language(spark, docs, sf_dir):
    """Documents in a language: not ``und`` and of ``LEAST_SCORE`` or more."""
    found = identify(docs, fit_languages(docs), carry=docs.columns)
    return _rows(found, docs, (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE))


def toxicity(spark, docs, sf_dir):
    """Documents that are not predicted toxic."""
    found = score(docs, fit_toxicity(docs, read(spark, sf_dir, "labels")), carry=docs.columns)
    return _rows(found, docs, F.col("predicted") == 0)


def dedup(spark, docs, sf_dir):
    """One row of each near-duplicate group (linked by 5-word shingles at
    Jaccard 0.8 or more): of the smallest doc_id, and if that has several texts
    in the group, of the smallest text hash. Documents without words and rows
    without a doc_id stay."""
    groups = jaccard_components(docs, n=DEDUP_WORDS, percent=DEDUP_PERCENT).where("id is not null and component is not null").select("id", "text_hash", "component")
    first = groups.groupBy("component").agg(F.min(F.struct("id", "text_hash")).alias("first"))
    drop = groups.join(first, "component").where((F.col("id") != F.col("first.id")) | (F.col("text_hash") != F.col("first.text_hash")))
    drop = drop.select("id", F.col("text_hash").alias("hash")).distinct()
    # The documents' columns by place, so that no name clashes with the keys.
    names = [f"_kept_{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names)
    doc_id, text = (F.col(names[docs.columns.index(c)]) for c in ("doc_id", "text"))
    match = (doc_id == F.col("id")) & (F.xxhash64(text) == F.col("hash"))
    kept = rows.join(drop, match, "left_anti")
    again = groups.groupBy("id", F.col("text_hash").alias("hash")).agg(F.count("*").alias("rows")).where("rows > 1").select("id", "hash")
    if not again.isEmpty():
        one = kept.join(again, match, "left_semi").withColumn("nth", F.row_number().over(W.partitionBy(doc_id, F.xxhash64(text)).orderBy(doc_id)))
        kept = kept.join(again, match, "left_anti").unionByName(one.where("nth = 1").drop("nth"))
    return kept.toDF(*docs.columns)


def packing(spark, docs, sf_dir):
    """Pieces of all remaining documents in sequences of at most 1024 tokens."""
    out = pack_documents(docs)
    return out.select(F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [("language id", language), ("toxicity", toxicity), ("n-gram jaccard join", dedup), ("packing", packing)]

#: SQL cannot express the two learned stages; tests hold ``run`` against a
#: brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
