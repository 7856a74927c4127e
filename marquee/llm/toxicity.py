"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence is toxic with probability
``sigmoid(bias + sum of the weights of its distinct features)``; a document is
toxic if any of its sentences is, so its score is the noisy-or
``1 - prod(1 - p)``. Only documents have labels: the likelihood of the
document score trains the sentence weights, which then point at the offending
sentences.

Features of a word (lower-cased, letters and digits) are the word and its
first four and five characters, hashed. Training takes at most
``Settings.per_label`` labelled documents of each label, chosen by a hash of
the id; scoring reads whole texts of all documents, partition by partition,
with the weights as a broadcast of fixed size (``2 ** BITS`` numbers).

Defined cases: a null or empty text, or one without words, has no sentence and
scores 0. Labels that are null are not used; a document with several labels is
toxic if any says so. Documents whose id is null are never learned from. If
there are no labels of one kind, all documents score 0.
"""

from __future__ import annotations

import re
import sys
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import ROW, numbered, placed, sized, slices, stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 18
WORD = re.compile(r"\w+")
#: A sentence ends with the sentence's marks or at a line break ...
SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
#: ... or after so many words, so that text without marks still has sentences.
MOST_WORDS = 40
#: Words that a task remembers the weight of.
MEMO = 300_000

SPAN = T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType()),
])
SCORED = T.StructType([
    T.StructField(ROW, T.LongType()), T.StructField("score", T.DoubleType()),
    T.StructField("n_sentences", T.IntegerType()), T.StructField("offending", T.ArrayType(SPAN)),
])


@dataclass(frozen=True)
class Settings:
    """per_label: most documents of each label that are learned from; learned_chars: longest text learned from;
    bias: where the sentence bias starts, low enough for texts of many sentences;
    lasso: evidence below so many toxic documents counts as noise;
    settled: step after which features without weight are left out."""

    per_label: int = 2_000
    learned_chars: int = 200_000
    least_docs: int = 3
    steps: int = 240
    settled: int = 40
    rate: float = 0.8
    lasso: float = 0.05
    bias: float = -11.0
    offending: float = 0.5


def features(word: str) -> tuple[int, int, int]:
    mask = (1 << BITS) - 1
    return tuple(
        zlib.crc32(x.encode("utf-8", "replace")) & mask for x in ("w" + word, "4" + word[:4], "5" + word[:5])
    )


def sentences(text: str):
    """Start, end and distinct words of each sentence that has a word."""
    lower = text.lower()
    if len(lower) != len(text):  # few letters change length; their places must not
        lower = "".join(x if len(x := c.lower()) == 1 else c for c in text)
    for m in SENTENCE.finditer(lower):
        words = WORD.findall(m[0])
        if len(words) <= MOST_WORDS:
            if words:
                yield m.start(), m.end(), set(words)
            continue
        found = list(WORD.finditer(lower, m.start(), m.end()))
        for at in range(0, len(found), MOST_WORDS):
            part = found[at:at + MOST_WORDS]
            yield part[0].start(), part[-1].end(), {w[0] for w in part}


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def bags(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """``toxic``, sentence lengths and features of the documents to learn from."""
    labelled = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    labelled = labelled.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = None
    for toxic in (0, 1):
        part = labelled.where(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.per_label)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = docs.select("doc_id", "text").where(F.length("text") <= settings.learned_chars).join(
        sized(stage(chosen), 16), "doc_id"
    )

    def task(batches):
        for batch in slices(batches):
            lengths, hashed = [], []
            for text in batch.column(1).to_pylist():
                found = [sorted({f for w in words for f in features(w)}) for _, _, words in sentences(text)]
                lengths.append([len(x) for x in found])
                hashed.append([f for x in found for f in x])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.list_(pa.int32())), pa.array(hashed, pa.list_(pa.int32()))],
                ["toxic", "lengths", "features"],
            )

    return rows.select(F.col("toxic").cast("int").alias("toxic"), "text").mapInArrow(
        task, "toxic int, lengths array<int>, features array<int>"
    )


def fit(learned: pa.Table, settings: Settings) -> np.ndarray | None:
    """Weights of the features, then the bias; None if one label is missing.

    Minimises the log loss of the noisy-or with an L1 penalty, by proximal
    steps with a rate per weight.
    """
    y = learned.column("toxic").to_numpy()
    lengths = learned.column("lengths").combine_chunks()
    per_doc = np.diff(lengths.offsets.to_numpy())
    y, keep = y[per_doc > 0], per_doc[per_doc > 0]
    if not (y == 0).any() or not (y == 1).any():
        return None
    n_words = lengths.flatten().to_numpy()
    code = learned.column("features").combine_chunks().flatten().to_numpy()
    doc_of = np.repeat(np.arange(len(keep), dtype=np.int32), keep)
    # Features of very few documents say nothing about others.
    documents = np.zeros(1 << BITS, np.int32)
    ends = np.cumsum(np.bincount(doc_of, n_words, len(keep)).astype(np.int64))
    for start, end in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True):
        documents[np.unique(code[start:end])] += 1
    often = documents >= settings.least_docs
    names = np.flatnonzero(often)
    use = often[code]
    at = (np.cumsum(often, dtype=np.int32) - 1)[code[use]]
    sent_of = np.repeat(np.arange(len(n_words), dtype=np.int32), n_words)[use]
    del code, use
    w, bias = np.zeros(len(names)), settings.bias
    past, past_bias = np.full(len(names), 1e-8), 1e-8
    lasso = settings.lasso / (y == 1).sum()
    share = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    for step in range(settings.steps):
        if step == settings.settled:  # what has no weight by now is noise; go on with the rest
            alive = w != 0
            renumbered = np.cumsum(alive) - 1
            use = alive[at]
            at, sent_of = renumbered[at[use]], sent_of[use]
            names, w, past = names[alive], w[alive], past[alive]
        z = bias + np.bincount(sent_of, w[at], minlength=len(n_words))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        none = np.exp(np.bincount(doc_of, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(keep)))
        slope = np.where(y == 1, -none / np.maximum(1 - none, 1e-9), 1.0) * share
        dz = p * slope[doc_of]
        g = np.bincount(at, dz[sent_of], minlength=len(names))
        past += g * g
        rate = settings.rate / np.sqrt(past)
        w -= rate * g
        w = np.sign(w) * np.maximum(np.abs(w) - rate * lasso, 0)
        past_bias += (gb := dz.sum()) ** 2
        bias -= 0.3 * settings.rate * gb / np.sqrt(past_bias)
    model = np.zeros((1 << BITS) + 1)
    model[names], model[-1] = w, bias
    return model


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> np.ndarray | None:
    return fit(bags(docs, labels, settings).toArrow(), settings)


class Scorer:
    """Scores texts with trained weights; remembers words up to a bound."""

    def __init__(self, model: np.ndarray | None, offending: float):
        self.weights = None if model is None else model[:-1].tolist()
        self.bias = 0.0 if model is None else float(model[-1])
        self.offending, self.memo = offending, {}

    def weight(self, words: set[str]) -> float:
        memo, z = self.memo, 0.0
        for word in words:
            if (w := memo.get(word)) is None:
                if len(memo) > MEMO:
                    memo.clear()
                a, b, c = features(word)
                w = self.weights[a] + self.weights[b] + self.weights[c]
                if len(word) < 64:
                    memo[word] = w
            z += w
        return z

    def __call__(self, text: str | None) -> tuple[float, int, list[dict]]:
        """Score, number of sentences, and the spans of those that offend."""
        spans, none, n = [], 1.0, 0
        for start, end, words in sentences(text or ""):
            n += 1
            if self.weights is None:
                continue
            p = 1 / (1 + np.exp(-min(30.0, max(-30.0, self.bias + self.weight(words)))))
            none *= 1 - p
            if p >= self.offending:
                spans.append({"start": start, "end": end, "score": float(p)})
        return float(1 - none), n, spans


def scored(rows: DataFrame, model: np.ndarray | None, settings: Settings = Settings()) -> DataFrame:
    """Score, sentence count and offending spans (places in characters) of numbered rows with ``text``."""
    shared = rows.sparkSession.sparkContext.broadcast(None if model is None else model.astype(np.float32))

    def task(batches):
        score = Scorer(shared.value, settings.offending)
        for batch in slices(batches):
            found = [score(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([x[0] for x in found], pa.float64()), pa.array([x[1] for x in found], pa.int32()),
                pa.array([x[2] for x in found], pa.list_(pa.struct(
                    [("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]
                ))),
            ], SCORED.names)

    return rows.select(ROW, "text").mapInArrow(task, SCORED)


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: id, held_out, score, predicted, n_sentences, offending spans."""
    model = train(docs, labels, settings)
    # The id is carried through the task as the row's number: no join is needed.
    return scored(docs.select(F.col("doc_id").cast("long").alias(ROW), "text"), model, settings).select(
        F.col(ROW).alias("doc_id"), held_out(F.col(ROW)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_sentences", "offending",
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that score below 0.5, with all their columns. Texts do not move.

    ``docs`` is read twice (see ``placed``).
    """
    model = train(docs, labels, settings)
    docs = placed(docs)
    dropped = stage(scored(numbered(docs, "text"), model, settings).where("score >= 0.5").select(ROW))
    return docs.join(sized(dropped, 16), ROW, "left_anti").drop(ROW)
