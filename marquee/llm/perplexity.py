"""Quality rules: counts of bad signs, and bands of character n-gram perplexity.

One modified Kneser-Ney model of character five-grams is counted by Spark over
all documents (``grams``). Its table grows with the corpus and is not
broadcast: rows are dealt to blocks of consecutive rows of a file, each block's
distinct n-grams are joined with the model, and what a block needs comes back
to it as one sorted array, in which its documents look their n-grams up. Five
characters tell the language, so one model serves all, and quotations too.

There are two measures, log perplexity per character and per word: text of odd
pieces is unlike others by character, and words with signs stuck to them only
by word. Their bands are set for each language and size class (power of two of
characters, as short texts scatter more): ``Settings.width`` interquartile
ranges beyond the quartiles of all documents that pass the counted rules. A
document beyond a band in either direction is rejected.
Quartiles of few documents are drawn towards those of their language, and
those of a rare language towards those of all documents, by
``Settings.prior`` documents. Any number of languages has bands.

Defined cases: a null or empty text has no words, so the base rules reject it,
and its perplexities are null. A missing language counts as a language. An empty
table gives no rows. Equal rows are judged alike. A band that cannot be set (no
document passed) accepts all.
"""

from __future__ import annotations

import sys
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import ROW, placed, sized, slices, stage
from marquee.llm.grams import block_grams, grams_of, probabilities, symbol_table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIGNS = b"#*$%&|<>"
#: Each measure, and the prefix of the names of its limits.
MEASURES = {"log_perplexity": "", "word_log_perplexity": "word_"}


@dataclass(frozen=True)
class Settings:
    """width: interquartile ranges that the band goes beyond the quartiles; prior: documents that a wider group's
    quartiles count as; block_bits: rows of a block, as a power of two."""

    width: float = 3.0
    prior: int = 40
    block_bits: int = 13
    least_words: int = 50
    most_repeated: int = 50


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words that occurs twice or more."""
    n = len(words)
    if n < 4:
        return 0
    numbers: dict[bytes, int] = {}
    at = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    m = len(numbers)
    pairs = at[:-1] * m + at[1:]
    if m > 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, which, count = np.unique(pairs[:-1] * m + at[2:], return_inverse=True, return_counts=True)
    again = count[which] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= again
    return int(covered.sum())


def signs(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.split()
    body = b"".join(words)
    lines = Counter(line for line in text.split(b"\n") if line.strip()) if b"\n" in text else {}
    return (
        len(words), len(body.decode("utf-8", "replace")), sum(body.count(SIGNS[i:i + 1]) for i in range(len(SIGNS))),
        sum(n - 1 for n in lines.values()), repeated_words(words),
    )


SCORED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("model", T.StringType()),
    *(T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
    T.StructField("size", T.IntegerType()), *(T.StructField(n, T.DoubleType()) for n in MEASURES),
])


def losses(texts: list[str], codes: np.ndarray, logs: np.ndarray, table: np.ndarray) -> list[float | None]:
    """Negative log probability of each text, from sorted n-grams and their values; null for an empty one."""
    out: list[float | None] = []
    for grams in grams_of(texts, table):
        if not len(grams):
            out.append(None)
            continue
        own, n = np.unique(grams, return_counts=True)
        at = np.searchsorted(codes, own)
        if len(codes) <= at[-1] or (codes[at] != own).any():
            raise ValueError("an n-gram of a document is not in the model of its block")
        out.append(float(-(logs[at] @ n)))
    return out


PACKED = T.StructType([T.StructField("block", T.LongType()), T.StructField("packed", T.BinaryType())])


def packed(docs: DataFrame) -> DataFrame:
    """``docs`` (block, doc_id, lang, text) as compressed Arrow streams of 4 MB of rows, or one long text, of one block each."""

    def task(batches):
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
        for batch in slices(batches, 4 << 20, 4096):
            blocks = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(blocks)]
            for a, b in zip(edges, edges[1:], strict=False):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema, options=options) as stream:
                    stream.write_batch(batch.slice(a, b - a))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(blocks[a:a + 1]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], PACKED.names
                )

    return docs.select("block", "doc_id", "lang", "text").mapInArrow(task, PACKED)


def scored(docs: DataFrame, model: DataFrame) -> DataFrame:
    """Signs and perplexities of each row (``docs``: block, doc_id, lang, text; ``model``: block, code, log_p)."""

    def task(batches):
        table, now, parts, known = symbol_table(), None, [], None
        for batch in slices(batches, 8 << 20, 1 << 16):
            key = batch.column(0).to_numpy() * 2 + batch.column(1).to_numpy()
            edges = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
            for a, b in zip(edges, edges[1:], strict=False):
                run = batch.slice(a, b - a)
                if key[a] >> 1 != now:
                    now, parts, known = key[a] >> 1, [], None
                if not key[a] & 1:
                    parts.append((run.column(2).to_numpy(), run.column(3).to_numpy()))
                    continue
                if known is None:
                    known = tuple(map(np.concatenate, zip(*parts, strict=True))) if parts else (np.zeros(0, np.int64), np.zeros(0))
                    parts = []
                for stream in run.column(4):
                    for rows in pa.ipc.open_stream(stream.as_buffer()):
                        yield judged_rows(rows, known, table)

    def judged_rows(rows, known, table):
        raw = [x or b"" for x in rows.column(3).cast(pa.binary()).to_pylist()]
        texts = [x.decode("utf-8", "replace") for x in raw]
        counts = list(zip(*map(signs, raw), strict=True))
        loss = losses(texts, *known, table)
        return pa.RecordBatch.from_arrays([
            rows.column(1), rows.column(2), *(pa.array(c, pa.int64()) for c in counts),
            pa.array([len(t).bit_length() for t in texts], pa.int32()),
            pa.array([x if x is None else x / len(t) for x, t in zip(loss, texts, strict=True)], pa.float64()),
            pa.array([x / n if n and x is not None else None for x, n in zip(loss, counts[0], strict=True)], pa.float64()),
        ], SCORED.names)

    first = model.select("block", F.lit(0).alias("kind"), "code", "log_p", F.lit(None).cast("binary").alias("packed"))
    then = packed(docs).select(
        "block", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("code"), F.lit(None).cast("float").alias("log_p"), "packed"
    )
    return first.union(then).repartition("block").sortWithinPartitions("block", "kind", "code").mapInArrow(task, SCORED)


def bands(judged: DataFrame, settings: Settings) -> DataFrame:
    """``model``, ``size`` and the limits of both measures, from all documents that passed the base rules."""
    good = judged.where("not base_failed")

    def quartiles(mark):
        return [
            F.percentile_approx(m, q, 10_000).alias(f"{mark}_{name}_{m}")
            for m in MEASURES for q, name in ((0.25, "q1"), (0.75, "q3"))
        ]

    own = good.groupBy("model", "size").agg(F.count("*").alias("n"), *quartiles("own"))
    by_lang = good.groupBy("model").agg(F.count("*").alias("n_lang"), *quartiles("lang"))
    rows = own.join(by_lang, "model").join(F.broadcast(good.agg(*quartiles("all"))))  # one row
    prior = F.lit(settings.prior)

    def drawn(name):
        lang = (F.col("n_lang") * F.col(f"lang_{name}") + prior * F.col(f"all_{name}")) / (F.col("n_lang") + prior)
        return (F.col("n") * F.col(f"own_{name}") + prior * lang) / (F.col("n") + prior)

    limits = []
    for m, prefix in MEASURES.items():
        low, high = drawn(f"q1_{m}"), drawn(f"q3_{m}")
        reach = settings.width * (high - low)
        limits += [(low - reach).alias(f"{prefix}lower"), (high + reach).alias(f"{prefix}upper")]
    return rows.select("model", "size", *limits)


def perplexities(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Signs, size class and perplexities of each row, by a model of all rows."""
    rows = placed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("lang"), "text"))
    rows = rows.withColumn("block", F.shiftright(ROW, settings.block_bits))
    counted = stage(block_grams(rows))
    model = stage(probabilities(counted))
    return scored(rows, counted.select("block", "code").join(model, "code"))


def judge_quality(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs``: counts, base_failed, both perplexities, the bands they are held to, kept."""
    judged = stage(perplexities(docs, settings)).withColumn(
        "base_failed",
        (F.col("n_words") < settings.least_words) | (100 * F.col("n_repeat_words") > settings.most_repeated * F.col("n_words")),
    )
    limits = sized(stage(bands(judged, settings)), 96)
    inside = F.lit(True)
    for m, prefix in MEASURES.items():
        inside &= F.coalesce(F.col(m).between(F.col(f"{prefix}lower"), F.col(f"{prefix}upper")), F.lit(True))
    return judged.join(limits, ["model", "size"], "left").withColumn("kept", ~F.col("base_failed") & inside)
