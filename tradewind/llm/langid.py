"""Language identification with a linear-chain conditional random field.

Training reads a bounded sample of labelled rows, in one task: about ``SAMPLE``
documents of each of the ``LANGUAGES`` most frequent languages (by a hash of the
id), whatever their length; of a longer one, a window of ``SAMPLE_CHARS``
characters. Runs of their words are strung into
code-switched texts, each word labelled with its document's language, so the
learned transitions know both staying and switching. Every word of every whole
text is then labelled by forward-backward; a document's language is the label
with the largest summed marginal.
"""
from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm import crf
from tradewind.llm.common import carried, crc32_mod, give_back, in_one_task, read, text_batches

SAMPLE = 400          # documents a language
SAMPLE_CHARS = 4_000  # of one sampled document: a longer one's window
LANGUAGES = 64        # learned: those with most rows
RUNS = 6              # runs of words taken from each sampled document
SHORTEST, LONGEST = 5, 40  # words in a run
SLICE = 200_000       # bytes of text labelled together: arrays of some 100 times as much
UNKNOWN = "und"
_ASCII_LETTER = re.compile("[A-Za-z]")
_WORD = re.compile(r"[^\W\d_]+")


def has_letter(text: str) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text))


def window(text_col: str, order, chars: int):
    """A text of at most ``chars`` characters as it is; of a longer one a
    window of so many, at a place drawn from the hash ``order``."""
    text, size = F.col(text_col), F.length(text_col)
    at = F.pmod(F.xxhash64(order), (size - chars + 1).cast("long")) + 1
    return F.when(size <= chars, text).otherwise(F.substr(text, at.cast("int"), F.lit(chars)))


def sample_rows(df: DataFrame, label_col: str, text_col: str, order, per_label: int, chars: int = SAMPLE_CHARS,
                most_labels: int = LANGUAGES) -> DataFrame:
    """``label``, ``text``, ``o``: about ``1.3 * per_label`` rows of each of the
    ``most_labels`` most frequent labels, ``2 * per_label`` a label at most over
    all, picked by the hash ``order`` (a column); of each text its ``window``.
    Counts first, then one filtering pass that knows each label's share."""
    rows = df.select(F.col(label_col).alias("label"), F.col(text_col).alias("text"), order.alias("o")).where("label is not null and text is not null")
    counts = rows.groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label").limit(most_labels)
    share = counts.select(F.col("label").alias("of"), F.least(F.lit(1.0), F.lit(1.3 * per_label) / F.col("n")).alias("share"))
    unit = F.pmod("o", F.lit(1 << 30)) / float(1 << 30)
    picked = rows.join(F.broadcast(share), F.col("label") == F.col("of")).where(unit < F.col("share"))  # most_labels rows
    text = window("text", F.col("o"), chars)
    return picked.select("label", text.alias("text"), "o").orderBy("o", "label", "text").limit(2 * per_label * most_labels)


def lowest(rows: list[dict], per_label: int) -> list[tuple[str, str]]:
    """The ``per_label`` rows of each label with the lowest hashes, as (label, text)."""
    kept: dict = {}
    for r in sorted(rows, key=lambda r: (r["o"], r["text"])):
        of = kept.setdefault(r["label"], [])
        if len(of) < per_label:
            of.append(r["text"])
    return [(label, t) for label in sorted(kept) for t in kept[label]]


def train(rows: list[tuple[str, str]], seed: int = 7) -> crf.Model | None:
    """``rows``: (language, text). None without any usable row."""
    rng = np.random.default_rng(seed)
    labels = sorted({label for label, _ in rows})
    runs = []
    for label, text in rows:
        words = _WORD.findall(crf.fold(text))
        for _ in range(min(RUNS, -(-len(words) // SHORTEST))):
            size = int(rng.integers(SHORTEST, LONGEST + 1))
            at = int(rng.integers(0, max(1, len(words) - size + 1)))
            runs.append((labels.index(label), words[at:at + size]))
    if not any(w for _, w in runs):
        return None
    order = rng.permutation(len(runs))
    texts, gold, k = [], [], 0
    while k < len(order):
        part = [runs[i] for i in order[k:k + int(rng.integers(1, 5))]]
        k += len(part)
        texts.append(" ".join(w for _, ws in part for w in ws))
        gold += [label for label, ws in part for _ in ws]
    words = [crf.Words(part).features() for part in crf.slices(texts)]
    assert sum(w.n for w in words) == len(gold)
    return crf.fit(words, np.array(gold), labels)


def identify(df: DataFrame, model: crf.Model | None, id_col: str = "doc_id", text_col: str = "text",
             carry: list[str] | None = None) -> DataFrame:
    """``id``, ``lang_pred``, ``score`` (mean marginal of that language, 0 to
    1), ``n_words`` long and ``langs`` (language -> words expected in it).

    A text that is null or has no letter, or any text without a model, is
    ``und`` with score 0. Ties go to the first language in order. Repeated
    rows and null ids are answered like any others. Columns in ``carry`` follow under their own names."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    rows, source, schema, named = carried(df, id_col, text_col, carry or [])
    keep = [f"k{i}" for i in range(len(named))]

    def run(batches):
        import pyarrow as pa
        m = shared.value
        give_back()
        names = ["id", "lang_pred", "score", "n_words", "langs"]
        for whole in batches:
            for b in text_batches(whole, ["text"], SLICE):
                texts = b.column("text").to_pylist()
                rows = [(UNKNOWN, 0.0, 0, {})] * len(texts)
                if m is not None:
                    words = crf.Words(texts)
                    sums = np.concatenate([np.zeros((1, len(m.labels))), np.cumsum(m.marginals(words), axis=0)])
                    mass = sums[words.first[1:]] - sums[words.first[:-1]]
                    for i, t in enumerate(texts):
                        n = int(words.first[i + 1] - words.first[i])
                        if n and has_letter(t):
                            best = int(mass[i].argmax())
                            rows[i] = (m.labels[best], min(1.0, float(mass[i, best] / n)), n,
                                       {label: float(x) for label, x in zip(m.labels, mass[i], strict=True)})
                cols = list(zip(*rows, strict=True)) or [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.float64()), pa.array(cols[2], pa.int64()),
                     pa.array([list(x.items()) for x in cols[3]], pa.map_(pa.string(), pa.float64())),
                     *[b.column(c) for c in source]], names=[*names, *keep])

    return rows.mapInArrow(run, "id long, lang_pred string, score double, n_words long, langs map<string,double>" + schema).select(
        "id", "lang_pred", "score", "n_words", "langs", *named)


def fit_languages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  per_label: int = SAMPLE) -> crf.Model | None:
    """A model from rows of ``df`` that may be learned from: a language, and
    an id whose crc32 mod 4 is not 2."""
    known = df.where(F.coalesce(crc32_mod(id_col, 4) != 2, F.lit(False)))
    rows = sample_rows(known, lang_col, text_col, F.xxhash64(F.col(id_col), F.lit("lang")), per_label)
    return in_one_task(rows, lambda got: train(lowest(got, per_label)))


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    """Predicted language of all documents."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = identify(docs, fit_languages(docs))
    return out.select(F.col("id").alias("doc_id"), F.coalesce(crc32_mod("id", 4) == 2, F.lit(False)).alias("held_out"),
                      "lang_pred", "score")
