"""Character trigrams of whole texts, counted per language by Spark.

Characters are lower-cased and mapped to 64 symbols: letters, one symbol for
digits, blanks, marks, and twelve that other letters share by a hash. So there
are at most 64**3 = 262,144 trigrams of a language, whatever the corpus.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import slices

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SYMBOLS = 64
CODES = SYMBOLS**3
BLANK, DIGIT = 0, 1
MARKS = ".,!?-'\"():;#*$%&|<>/@_=+"
OTHERS = SYMBOLS - 2 - 26 - len(MARKS)


def symbol_table() -> np.ndarray:
    points = np.arange(0x110000, dtype=np.int64)
    table = (SYMBOLS - OTHERS + points * 2654435761 % (1 << 32) * OTHERS // (1 << 32)).astype(np.uint8)
    table[:128] = BLANK
    table[[0x85, 0xA0, 0x2028, 0x2029]] = BLANK
    table[48:58] = DIGIT
    table[97:123] = np.arange(2, 28)
    for k, mark in enumerate(MARKS):
        table[ord(mark)] = 28 + k
    return table


def codes_of(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trigram code ending at each character of the texts, and where each text begins.

    Each text is read after two blanks, which have no code of their own.
    """
    lower = [t.lower() for t in texts]
    joined = "".join(f"  {t}" for t in lower)
    symbols = table[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int32)
    lengths = np.fromiter(map(len, lower), np.int64, len(lower))
    codes = symbols[:-2] << 12 | symbols[1:-1] << 6 | symbols[2:] if len(symbols) > 2 else np.zeros(0, np.int32)
    # The codes that end at the two blanks before a later text belong to no text.
    starts = np.concatenate([[0], np.cumsum(lengths)])
    real = np.ones(len(codes), bool)
    gaps = (starts[1:-1] + 2 * np.arange(len(lower) - 1)) if len(lower) else np.zeros(0, np.int64)
    real[gaps], real[gaps + 1] = False, False
    return codes[real], starts


COUNTED = T.StructType([
    T.StructField("lang", T.StringType()), T.StructField("code", T.IntegerType()), T.StructField("n", T.LongType()),
])


def trigram_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``code``, ``n`` over the whole texts of ``docs`` (columns lang, text). Tasks add up before the shuffle."""

    def task(batches):
        table, found = symbol_table(), {}
        for batch in slices(batches, 16 << 20, 4096):
            by: dict[str | None, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if text:
                    by.setdefault(lang, []).append(text)
            for lang, texts in by.items():
                if lang not in found and len(found) >= 64:  # a task holds few arrays; the sums come later
                    yield from flush(found)
                got = np.bincount(codes_of(texts, table)[0], minlength=CODES)
                found[lang] = found[lang] + got if lang in found else got
        yield from flush(found)

    def flush(found):
        for lang in list(found):
            counts = found.pop(lang)
            codes = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(codes), pa.string()), pa.array(codes, pa.int32()), pa.array(counts[codes], pa.int64())],
                COUNTED.names,
            )

    return docs.select("lang", "text").mapInArrow(task, COUNTED).groupBy("lang", "code").agg(F.sum("n").alias("n"))
