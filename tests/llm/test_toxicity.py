import random
import zlib

from tests.llm.helpers import EDGE, edge_docs, empty_docs
from tradewind.llm import toxicity as T

SF = "/root/testdata/sf0.1"


def test_query_on_held_out_documents(spark):
    out = {r.doc_id: r for r in T.op10_toxicity(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert set(out) == set(texts)
    held = [x for x in labels if zlib.crc32(str(x.doc_id).encode()) % 3 == 1]
    assert all(out[x.doc_id].held_out for x in held)
    toxic, clean = ([x.doc_id for x in held if x.toxic == k] for k in (1, 0))
    assert sum(out[i].predicted for i in toxic) >= 0.9 * len(toxic)
    assert sum(out[i].predicted for i in clean) <= 0.02 * len(clean)
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in out.values())
    words = [texts[i][s.start:s.stop].lower() for i in toxic for s in out[i].spans]
    assert words and {"idiot", "scum"} & set(words) and all(w.isalpha() for w in words)


def test_edge_rows_and_offsets(spark):
    rng = random.Random(8)
    rows = [(k, " ".join(["".join(rng.choices("aeiourstln", k=5)) for _ in range(12)] + k * ["grumble" + "".join(rng.choices("dfkn", k=3))]))
            for k in (0, 1) for _ in range(60)]
    model = T.train(rows)
    assert T.train([]) is None and T.train([(0, "12")]) is None
    df = spark.createDataFrame([(1, "É\U0001f642 grumblefoot, grumblefink!"), (2, "a calm river")], "doc_id long, text string")
    got = {r.id: r for r in T.score(df, model).collect()}
    assert [(s.start, s.stop) for s in got[1].spans] == [(3, 14), (16, 27)]
    assert got[2].spans == [] and got[1].score > got[2].score
    edge = T.score(edge_docs(spark, "predicted", "spans"), model, carry=["text"]).collect()
    assert len(edge) == len(EDGE)
    none = {r.score for r in edge if not (r.text or "").strip()}
    assert len(none) == 1  # no evidence, one score
    assert T.score(empty_docs(spark), model).count() == 0
    assert {(r.score, r.predicted) for r in T.score(df, None).collect()} == {(0.0, 0)}


def test_labels_that_fit_nothing(spark):
    labels = spark.createDataFrame([(1, 0, None), (None, 1, 1), (99, 0, 1), (2, 0, 7)], "doc_id long, quality int, toxic int")
    assert T.fit_toxicity(edge_docs(spark), labels) is None


def test_class_of_long_documents_only_is_learned(spark):
    rng = random.Random(4)

    def text(label, size):
        words = ["".join(rng.choices("aeiourstln", k=6)) for _ in range(size)]
        return " ".join("grumble" + "".join(rng.choices("dfkn", k=3)) if label and i % 40 == 7 else w for i, w in enumerate(words))
    rows = [(i, text(i % 2, 4000 if i % 2 else 60)) for i in range(120)]
    assert all(len(t) > 20_000 for i, t in rows if i % 2)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    got = {r.id: r.predicted for r in T.score(docs, T.fit_toxicity(docs, labels)).collect()}
    assert got == {i: i % 2 for i, _ in rows}


def test_training_holds_one_part_at_a_time():
    """A training task's memory goes by one part of the sample, not the sample."""
    import tracemalloc
    rng = random.Random(9)
    plain = ["".join(rng.choices("aeiourstln", k=6)) for _ in range(3000)]

    def text(label):
        words = rng.choices(plain, k=2800)
        words[::400] = ["grumble" + "".join(rng.choices("dfkn", k=3))] * 7 if label else words[::400]
        return " ".join(words)
    rows = [(i % 2, text(i % 2)) for i in range(160)]
    tracemalloc.start()
    model = T.train(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model.field.labels == ["clean", "toxic"]
    assert peak < 45_000_000
