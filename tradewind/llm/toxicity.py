"""Toxicity: a linear-chain conditional random field tags offending words.

Labels exist per document. A bounded sample of labelled documents (``SAMPLE``
a class, of a longer one a window of ``SAMPLE_CHARS`` characters) yields
labelled tokens: a word of a toxic document is offending if the word, or its
first 4 or 5 letters, stands in many times more toxic than clean documents;
every other word, and every word of a clean document, is not. The field learns
from these and so tags forms it has not seen. A document's score is a logistic
function, fitted on the same sample, of its whole text's marginals: the two
largest and the sum over tagged words.
"""
from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import crf
from tradewind.llm.common import carried, crc32_mod, give_back, in_one_task, read, text_batches
from tradewind.llm.langid import window

SAMPLE = 1200   # documents a class
SAMPLE_CHARS = 20_000  # of one sampled document: a longer one's window
RATIO = 20      # times as frequent in toxic documents
LEAST = 3       # toxic documents with the form
SPAN = 30       # words of context kept around an offending word in training
THRESHOLD = 0.7

_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class ToxicModel:
    field: crf.Model
    scale: np.ndarray  # logistic weights of the evidence


def _forms(word: str) -> tuple[str, ...]:
    return (word, word[:4] + "*", word[:5] + "*") if len(word) >= 5 else (word,)


def _kin(words: list[str]) -> tuple:
    """The smallest of a text's 3-word hashes: copies mostly share it."""
    return min(zip(words, words[1:], words[2:], strict=False), key=lambda g: zlib.crc32(" ".join(g).encode()), default=tuple(words))


def _words(text: str) -> list[str]:
    return _WORD.findall(crf.fold(text))


def offending_forms(rows: list[tuple[int, str]]) -> set[str]:
    """Words and stems that mark toxic documents, from (label, text). Near
    copies count once, so that their other words don't. One text's words are
    held at a time, and of clean documents only forms that stand in enough
    toxic ones are counted."""
    n, seen = [1, 1], [Counter(), Counter()]
    for label in (1, 0):
        kin = set()
        for words in (_words(t) for y, t in rows if y == label):
            if (key := _kin(words)) not in kin:
                kin.add(key)
                forms = {f for w in set(words) for f in _forms(w)}
                seen[label].update(forms if label else forms & seen[1].keys())
        if label:
            seen[1] = Counter({f: a for f, a in seen[1].items() if a >= LEAST})
        n[label] = max(1, len(kin))
    return {f for f, a in seen[1].items() if (a / n[1]) >= RATIO * ((seen[0][f] + 0.5) / n[0])}


def train(rows: list[tuple[int, str]], seed: int = 11) -> ToxicModel | None:
    """``rows``: (0 or 1, text). None without any word."""
    rng = np.random.default_rng(seed)
    bad = offending_forms(rows)
    texts, gold = [], []
    for label, t in rows:
        ws = _words(t)
        if not ws:
            continue
        marks = [int(label == 1 and not bad.isdisjoint(_forms(w))) for w in ws]
        hits = [i for i, x in enumerate(marks) if x] or [int(rng.integers(0, len(ws)))]
        for at in sorted({h // (2 * SPAN) for h in hits[:4]}):
            part = slice(at * 2 * SPAN, (at + 1) * 2 * SPAN)
            texts.append(" ".join(ws[part]))
            gold += marks[part]
    if not gold:
        return None
    field = crf.fit([crf.Words(part).features() for part in crf.slices(texts)], np.array(gold), ["clean", "toxic"])
    seen = []
    for part in crf.slices([t for _, t in rows]):
        words = crf.Words(part)
        seen.append(_evidence(words, field.marginals(words)[:, 1]))
    return ToxicModel(field, _logistic(np.concatenate(seen), np.array([label for label, _ in rows])))


def _evidence(words: crf.Words, p: np.ndarray) -> np.ndarray:
    """Per text: its largest and second largest marginal, the logarithm of the
    summed marginals of tagged words, and 1."""
    out = np.zeros((len(words.first) - 1, 4))
    out[:, 3] = 1
    full = np.flatnonzero(np.diff(words.first))
    if len(full):
        starts, rest = words.first[full], p.copy()
        out[full, 0] = np.maximum.reduceat(rest, starts)
        out[full, 2] = np.log1p(np.add.reduceat(np.where(p >= 0.5, p, 0), starts))
        top = np.flatnonzero(rest == np.repeat(out[full, 0], np.diff(words.first)[full]))
        text = np.searchsorted(words.first, top, "right") - 1
        rest[top[np.r_[True, np.diff(text) > 0]]] = 0  # the first of the largest
        out[full, 1] = np.maximum.reduceat(rest, starts)
    return out


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton's method with both classes weighted alike and a small ridge."""
    share = max(1, y.sum()), max(1, (1 - y).sum())
    w = np.where(y == 1, 0.5 / share[0], 0.5 / share[1])
    b = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        grad = x.T @ (w * (y - p)) - 1e-4 * b
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(len(b))
        b = b + np.linalg.solve(hess, grad)
    return b


def score(df: DataFrame, model: ToxicModel | None, id_col: str = "doc_id", text_col: str = "text",
          carry: list[str] | None = None) -> DataFrame:
    """``id``, ``score``, ``predicted`` (1 from ``THRESHOLD`` on) and ``spans``:
    code point starts and stops of the words tagged with marginal 0.5 or more.

    Texts that are null or without words get the score of no evidence;
    without a model every score is 0. Repeated rows and null ids are answered
    like any others. Columns in ``carry`` follow under their own names."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    rows, source, schema, named = carried(df, id_col, text_col, carry or [])
    keep = [f"k{i}" for i in range(len(named))]

    def run(batches):
        import pyarrow as pa
        m = shared.value
        give_back()
        for whole in batches:
            for b in text_batches(whole, ["text"], 200_000):
                texts = b.column("text").to_pylist()
                scores, spans = np.zeros(len(texts)), [[] for _ in texts]
                if m is not None:
                    w = crf.Words(texts)
                    p = m.field.marginals(w)[:, 1]
                    scores = 1 / (1 + np.exp(-np.clip(_evidence(w, p) @ m.scale, -30, 30)))
                    tagged = np.flatnonzero(p >= 0.5)
                    if len(tagged):
                        point = np.cumsum((w.spans.data & 0xC0) != 0x80)  # code points up to and with each byte
                        for i, t in zip(tagged.tolist(), (np.searchsorted(w.first, tagged, "right") - 1).tolist(), strict=True):
                            base = point[w.at[t]]
                            spans[t].append({"start": int(point[w.start[i]] - base), "stop": int(point[w.stop[i]] - base)})
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.array(scores, pa.float64()), pa.array((scores >= THRESHOLD).astype(np.int32), pa.int32()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                     *[b.column(c) for c in source]], names=["id", "score", "predicted", "spans", *keep])

    return rows.mapInArrow(run, "id long, score double, predicted int, spans array<struct<start:long,stop:long>>" + schema).select(
        "id", "score", "predicted", "spans", *named)


def fit_toxicity(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 per_class: int = SAMPLE) -> ToxicModel | None:
    """A model from labelled ids whose crc32 mod 3 is not 1, learned in one
    task. The sample of ids is taken from the narrow label table: at most ``2 *
    per_class`` rows; if sampled ids repeat, the ``4 * per_class`` texts with the
    lowest hashes, ties by text."""
    known = labels.select(F.col("doc_id").cast("long").alias("lid"), "toxic").where("toxic in (0, 1)")
    known = known.where(F.coalesce(crc32_mod("lid", 3) != 1, F.lit(False))).groupBy("lid").agg(F.max("toxic").alias("toxic"))
    known = known.withColumn("o", F.xxhash64("lid", F.lit("toxic")))
    picks = [known.where(F.col("toxic") == k).orderBy("o", "lid").limit(per_class) for k in (0, 1)]
    texts = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text is not null")
    rows = texts.join(F.broadcast(picks[0].unionByName(picks[1])), F.col("id") == F.col("lid"))  # 2 * per_class rows
    rows = rows.select("toxic", window("text", F.col("o"), SAMPLE_CHARS).alias("text"), "o").orderBy("o", "text").limit(4 * per_class)
    return in_one_task(rows, lambda got: train([(r["toxic"], r["text"]) for r in sorted(got, key=lambda r: (r["o"], r["text"]))]))


def op10_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = score(docs, fit_toxicity(docs, read(spark, sf_dir, "labels")))
    return out.select(F.col("id").alias("doc_id"), F.coalesce(crc32_mod("id", 3) == 1, F.lit(False)).alias("held_out"),
                      "score", "predicted", "spans")
