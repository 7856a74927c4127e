"""Character five-grams of whole texts, in how many documents each occurs, and their Kneser-Ney probabilities.

Characters keep their case and map to 4,096 symbols: code points below 2,048
(Latin, Greek, Cyrillic, Hebrew, Arabic) stand for themselves, the others share
2,048 symbols by a hash; blanks are one symbol, digits another. A five-gram is
60 bits, so its context and its shorter forms are shifts and masks, and all
levels of the model are groupings and joins of tables that grow with the
corpus. No context has more than 4,096 successors, so no key is hot.

An n-gram counts once per document, and the discount of those of one document
is a whole count: they are only worth what their shorter forms are. So a text
does not make itself likely.

Defined cases: a null or empty text has no n-grams; equal rows count each.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import slices, stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ORDER = 5
BITS = 12
SYMBOLS = 1 << BITS
#: Before the first character of each text.
START = 0
#: A task passes on what it has counted of a block beyond so many n-grams.
MOST_HELD = 2_000_000


def symbol_table() -> np.ndarray:
    points = np.arange(0x110000, dtype=np.int64)
    half = SYMBOLS // 2
    table = np.where(points < half, points, half + (points * 2654435761 % (1 << 32) * half >> 32)).astype(np.int16)
    table[:33] = table[[0x85, 0xA0, 0x2028, 0x2029]] = 32
    table[48:58] = 48
    return table


def grams_of(texts: list[str], table: np.ndarray) -> list[np.ndarray]:
    """The five-gram that ends at each character, for each text."""
    if not texts:
        return []
    pad = ORDER - 1
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) + pad for t in texts])
    symbols = np.full(int(ends[-1]), START, np.int64)
    real = np.ones(len(symbols), bool)
    for k in range(pad):
        real[ends - [len(t) for t in texts] - 1 - k] = False
    symbols[real] = table[points]
    codes = symbols.copy()
    for k in range(1, ORDER):
        codes[k:] |= symbols[:-k] << BITS * k
    return [codes[end - len(t):end] for t, end in zip(texts, ends.tolist(), strict=True)]


def added(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, and their summed counts."""
    every, n = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(every)
    every, n = every[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, np.int64)
    return every[first], np.add.reduceat(n, first) if len(first) else n


COUNTED = T.StructType([T.StructField(n, T.LongType()) for n in ("block", "code", "n")])


def block_grams(docs: DataFrame) -> DataFrame:
    """``block``, ``code`` and in how many documents of the block it occurs (columns block, text).

    A block whose rows lie in several tasks has rows from each.
    """

    def task(batches):
        table, now, codes, counts, held = symbol_table(), None, [], [], 0

        def flush():
            found, n = added(codes, counts)
            for at in range(0, len(found), 1 << 16):
                part = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found[part]), now)), pa.array(found[part]), pa.array(n[part])], COUNTED.names
                )

        for batch in slices(batches, 8 << 20, 1024):
            blocks, texts = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for block in dict.fromkeys(blocks.tolist()):
                if codes and block != now:
                    yield from flush()
                    codes, counts, held = [], [], 0
                now = block
                found = [np.unique(g) for g in grams_of([texts[i] for i in np.flatnonzero(blocks == block) if texts[i]], table)]
                if not found:
                    continue
                whole, n = np.unique(np.concatenate(found), return_counts=True)
                codes.append(whole)
                counts.append(n.astype(np.int64))
                held += len(whole)
                if held > MOST_HELD:
                    whole, n = added(codes, counts)
                    codes, counts, held = [whole], [n], len(whole)
                    if held > MOST_HELD // 2:
                        yield from flush()
                        codes, counts, held = [], [], 0
        if codes:
            yield from flush()

    return docs.select("block", "text").mapInArrow(task, COUNTED)


def discounts(n: list[int]) -> list[float]:
    """What is taken off counts of 1, 2 and 3 or more, from how many n-grams have the counts 1 to 4.

    Off 1 the whole; off the others what Chen and Goodman take, or a half
    where a count of counts is missing, as in small corpora.
    """
    if not all(n):
        return [1.0, 0.5, 0.5]
    y = n[0] / (n[0] + 2 * n[1])
    return [1.0, *(min(max((i + 1) - (i + 2) * y * n[i + 1] / n[i], 0.0), i + 1.0) for i in (1, 2))]


def taken(level: DataFrame) -> Column:
    """The discount of column ``n`` of a level of n-grams."""
    of = level.agg(*(F.count(F.when(F.col("n") == i, 1)) for i in range(1, 5))).first()
    one, two, more = map(F.lit, discounts(list(of)))
    return F.when(F.col("n") == 1, one).when(F.col("n") == 2, two).otherwise(more)


def probabilities(counted: DataFrame) -> DataFrame:
    """``code`` and ``log_p``: interpolated modified Kneser-Ney, for each five-gram of ``counted`` (columns code, n)."""
    levels = {ORDER: stage(counted.groupBy("code").agg(F.sum("n").alias("n")))}
    for k in range(ORDER - 1, 0, -1):
        # Shorter n-grams count in how many contexts they occur.
        shorter = levels[k + 1].select(F.col("code").bitwiseAND(F.lit((1 << BITS * k) - 1)).alias("code"))
        levels[k] = stage(shorter.groupBy("code").agg(F.count("*").alias("n")))
    lower = None
    for k in range(1, ORDER + 1):
        level = levels[k].select(
            "code", "n", taken(levels[k]).alias("off"), F.shiftright("code", BITS).alias("context"),
            F.col("code").bitwiseAND(F.lit((1 << BITS * (k - 1)) - 1)).alias("suffix"),
        )
        contexts = level.groupBy("context").agg(F.sum("n").alias("total"), F.sum("off").alias("rest"))
        rows = level.join(F.broadcast(contexts) if k <= 2 else contexts, "context")  # up to 4,096 contexts
        if lower is None:
            rows = rows.withColumn("below", F.lit(1 / SYMBOLS))
        else:
            below = lower.select(F.col("code").alias("suffix"), F.col("p").alias("below"))
            rows = rows.join(F.broadcast(below) if k == 2 else below, "suffix")
        lower = rows.select("code", ((F.col("n") - F.col("off") + F.col("rest") * F.col("below")) / F.col("total")).alias("p"))
    return lower.select("code", F.log("p").cast("float").alias("log_p"))
