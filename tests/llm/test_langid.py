import random
import zlib

from pyspark.sql import functions as F

from tests.llm.helpers import EDGE, edge_docs, empty_docs
from tradewind.llm import langid as L

SF = "/root/testdata/sf0.01"


def test_query_is_right_on_held_out_documents(spark):
    out = {r.doc_id: r for r in L.op4_language_id(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text").collect()
    assert len(out) == len(docs)
    for d in docs:
        r = out[d.doc_id]
        assert r.held_out == (zlib.crc32(str(d.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [d for d in docs if out[d.doc_id].held_out and d.lang]
    assert sum(out[d.doc_id].lang_pred == d.lang for d in held) >= 0.97 * len(held)


def _model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return L.fit_languages(docs, per_label=60)


def test_code_switched_text_and_edge_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) > 800")
    pieces = {r.lang: r.text[:400] for r in docs.groupBy("lang").agg(F.max("text").alias("text")).collect()}
    model = _model(spark)
    mixed = spark.createDataFrame([(1, pieces["en"] + " " + pieces["de"])], "doc_id long, text string")
    r = L.identify(mixed, model).first()
    assert min(r.langs["en"], r.langs["de"]) > 0.25 * r.n_words and r.lang_pred in ("en", "de")

    rows = L.identify(edge_docs(spark, "lang_pred", "langs", "k0"), model, carry=["score", "text", "doc_id"]).toDF(
        "id", "lang_pred", "score", "n_words", "langs", "clash", "text", "doc_id").collect()
    assert len(rows) == len(EDGE) and all(r.clash == "clash" and r.id == r.doc_id for r in rows)
    for r in rows:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("de", "en", "es", "fr") and 0 < r.score <= 1


def test_letters():
    assert all(map(L.has_letter, ["a", "é", "中", "12x"]))
    assert not any(map(L.has_letter, ["", "12", "²½", "\U0001f642", "_-!"]))


def test_no_rows_and_no_labels(spark):
    model = L.fit_languages(empty_docs(spark))
    assert model is None and L.identify(empty_docs(spark), model).count() == 0
    unlabelled = edge_docs(spark).withColumn("lang", F.lit(None).cast("string"))
    assert L.fit_languages(unlabelled) is None
    assert {r.lang_pred for r in L.identify(unlabelled, None).collect()} == {"und"}


def test_language_of_long_documents_only_is_learned(spark):
    """Long documents of a language that no short one has; its window differs
    from the text's beginning."""
    def text(letters, k, size):
        rng = random.Random(k)
        return " ".join("".join(rng.choices(letters, k=rng.randrange(3, 9))) for _ in range(size))
    rows = [(k, "aa", text("abcdef", k, 50)) for k in range(60)] + [(100 + k, "bb", text("uvwxyz", k, 5000)) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    assert all(len(t) > L.SAMPLE_CHARS for _, lang, t in rows if lang == "bb")
    order = F.xxhash64("doc_id")
    sample = L.lowest([r.asDict() for r in L.sample_rows(docs, "lang", "text", order, 100).collect()], 100)
    texts = {lang: [t for _, x, t in rows if x == lang] for lang in ("aa", "bb")}
    assert sorted(t for lang, t in sample if lang == "aa") == sorted(texts["aa"])
    windows = [t for lang, t in sample if lang == "bb"]
    assert len(windows) == 60 and all(len(t) == L.SAMPLE_CHARS and any(t in x for x in texts["bb"]) for t in windows)
    assert any(not x.startswith(t) for t in windows for x in texts["bb"] if t in x)
    out = L.identify(docs, L.fit_languages(docs)).collect()
    assert {r.id: r.lang_pred for r in out} == {k: lang for k, lang, _ in rows}


def test_labels_beyond_the_most_frequent_are_not_learned(spark):
    rows = [(k, f"l{k}", "x y") for k in range(40)] + [(100 + k, "aa", "x y") for k in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").withColumn("label", F.lit("clash"))
    got = L.sample_rows(docs, "lang", "text", F.xxhash64("doc_id"), 10, most_labels=3).collect()
    assert {r.label for r in got} == {"aa", "l0", "l1"} and len(got) == 7


def test_quotes_and_dashes_end_words():
    words = L.crf.Words(["“idiot” — l’état\u00a0²x", "idiot"])
    assert L.crf.fold("“Idiot”") == " idiot " and words.n == 5
    assert words.hash[0] == words.hash[-1]


def test_labelling_a_slice_takes_little_memory():
    """Every Python worker of an executor holds one slice at a time."""
    import tracemalloc

    import numpy as np

    from tradewind.llm import crf
    k = 8
    model = crf.Model([str(i) for i in range(k)], np.zeros((crf.BUCKETS, k), dtype=np.float32), np.zeros((k, k)), np.zeros(k),
                      np.zeros(1, dtype=np.uint64), np.array([k]), np.zeros((k + 1, k)))
    text = "words of some length " * (L.SLICE // 21)
    tracemalloc.start()
    assert model.marginals(crf.Words([text])).shape[1] == k
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80_000_000
