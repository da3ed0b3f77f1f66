"""The pipeline against its parts done plainly."""
import random

from pyspark.sql import functions as F

import corpus_pipeline as P
from tests.llm.helpers import SF, edge_docs, empty_docs
from tests.llm.test_ngram_join import brute_components
from tests.llm.test_packing import check
from tradewind.llm import langid, toxicity


def test_stages_and_run(spark):
    assert [n for n, _ in P.STAGES] == ["language id", "toxicity", "n-gram jaccard join", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}

    kept = P.language(spark, docs, SF)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    lang = {r.id for r in langid.identify(docs, langid.fit_languages(docs)).collect() if r.lang_pred != "und" and r.score >= P.LEAST_SCORE}
    assert {r.doc_id: r for r in kept.collect()} == {i: rows[i] for i in lang}
    assert all(any(c.isalpha() for c in rows[i].text or "") for i in lang)

    kept, labels = docs.where(F.col("doc_id").isin(*lang)), spark.read.parquet(f"{SF}/labels.parquet")
    mild = {r.id for r in toxicity.score(kept, toxicity.fit_toxicity(kept, labels)).collect() if r.predicted == 0}
    assert {r.doc_id: r for r in P.toxicity(spark, kept, SF).collect()} == {i: rows[i] for i in mild}

    kept = docs.where(F.col("doc_id").isin(*mild))
    first = {c for _, _, c in brute_components([(i, rows[i].text or "") for i in sorted(mild)])}
    assert {r.doc_id: r for r in P.dedup(spark, kept, SF).collect()} == {i: rows[i] for i in first}

    packed = [tuple(r) for r in P.run(spark, SF).collect()]
    check(packed, [(i, rows[i].text or "") for i in first])


def test_stages_take_edge_rows(spark):
    docs = edge_docs(spark, "source", "n_chars", "component_id", "lang_pred", "toxic", "lid", "_id", "_hash", "hash", "nth", "o", "label").withColumn("lang", F.lit(None).cast("string"))
    clean = P.language(spark, docs, SF)  # no usable language: every document is undetermined
    assert clean.count() == 0 and clean.columns == docs.columns
    calm = P.toxicity(spark, docs, SF)
    assert calm.columns == docs.columns and calm.count() <= docs.count()
    one = P.dedup(spark, docs, SF)
    got = sorted(((r.doc_id, r.text or "") for r in one.collect()), key=repr)
    texts = {(i, t or "") for i, t in ((r.doc_id, r.text) for r in docs.collect())}
    # Document 1 stands for its copies; texts without words and rows without an id stay.
    assert got == sorted(texts - {(5, "the quick brown fox jumps over the lazy dog")}, key=repr)
    empty = empty_docs(spark)
    for _, stage in P.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_dedup_links_five_words_from_four_fifths_on(spark):
    """Copies on both sides of 0.8, by a replaced run and by appended words,
    and where 4-word and 5-word shingles disagree."""
    rng = random.Random(3)
    def words(k):
        return [f"w{rng.randrange(10**9)}" for _ in range(k)]
    rows = []
    for run in (0, 30, 38, 44, 50, 51, 52, 53, 54, 60):
        base = words(500)
        rows += [base, base[:200] + words(run) + base[200 + run:]]
    for more in (80, 90, 110, 120, 124, 125, 130):
        base = words(500)
        rows += [base, base + words(more)]
    for holes in (8, 10, 11, 12, 13, 14):  # each costs n shingles
        base = words(500)
        copy = list(base)
        for i in range(holes):
            copy[20 + 35 * i] = f"x{rng.randrange(10**9)}"
        rows += [base, copy]
    sets = [{tuple(r[i:i + 5]) for i in range(len(r) - 4)} for r in rows]
    shares = [len(a & b) / len(a | b) for a, b in zip(sets[::2], sets[1::2], strict=True)]
    assert sum(0.8 <= s < 0.85 for s in shares) >= 5 and sum(s < 0.8 for s in shares) >= 3
    stay = {i for i in range(len(rows)) if i % 2 == 0 or shares[i // 2] < 0.8}
    docs = spark.createDataFrame([(i, " ".join(r)) for i, r in enumerate(rows)], "doc_id long, text string").repartition(4)
    assert {r.doc_id for r in P.dedup(spark, docs, SF).collect()} == stay
