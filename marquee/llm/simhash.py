"""Near duplicates by SimHash, joined by meeting in the middle.

Two fingerprints that differ in at most two bits have a fingerprint in common
that differs from each in at most one. So each distinct fingerprint emits its
ball of radius one (itself and its 64 neighbours), the variants are shuffled,
and fingerprints that meet at a variant are linked. A variant is met by 65
fingerprints at most, whatever the data, since copies were merged before. All
that meet at one variant are within two bits of each other, so linking each to
the next keeps them together without emitting all pairs. Linked pairs are
checked by counting bits and joined into components.

Defined cases: A-Z are lower-cased; words are runs of other than space and tab
to carriage return; shingles of ``width`` words count as often as they occur;
a text with fewer words is one shingle; one without words, or null, has
fingerprint zero, linked like any other. Null ids are larger than all others.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import ROW, as_bytes, numbered, placed, sized, slices, stage
from marquee.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Hashes whose bits are counted at once.
BLOCK = 1 << 14


def fingerprint(text: bytes, width: int) -> int:
    """SimHash of one text as a signed 64-bit number."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = ends - np.fromiter(map(len, words), np.int64, len(words)) - 1
    n = max(1, len(words) - width + 1)
    last = ends[min(width, len(words)) - 1:] - 1
    hash64 = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        pairs = zip(starts[at:min(at + BLOCK, n)].tolist(), last[at:at + BLOCK].tolist(), strict=True)
        hashes = np.array([hash64(joined[a:b], 42) for a, b in pairs], np.dtype("<u8"))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """Number, id and fingerprint ``fp`` of each row, written as a table."""
    rows = numbered(docs, F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def task(batches):
        for batch in slices(batches):
            fps = [fingerprint(text, width) for text in as_bytes(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps, pa.int64())], [ROW, "id", "fp"]
            )

    schema = T.StructType([
        T.StructField(ROW, T.LongType()), T.StructField("id", rows.schema["id"].dataType), T.StructField("fp", T.LongType()),
    ])
    return stage(rows.select(ROW, "id", "text").mapInArrow(task, schema))


def links(distinct: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` of distinct fingerprints ``fp``, at most two bits apart, that connect all such pairs."""
    ball = distinct.select(
        "fp", F.explode(F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")).alias("variant")
    )
    # At most 65 rows have one variant, so the window stays small.
    met = ball.selectExpr("fp as a", "lag(fp) over (partition by variant order by fp) as b").where("b is not null")
    return met.where("bit_count(a ^ b) <= 2").distinct()


def grouped(fps: DataFrame, first: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows of ``fps`` with the least id of their component; ``first``: the first row of each ``fp``; ``pairs``: what links them."""
    joined = sized(components(pairs), 16)
    known = stage(
        first.join(joined, first["fp"] == joined["node"], "left")
        .select("fp", "first", F.coalesce("component", "fp").alias("component"))
    )
    whole = stage(known.groupBy("component").agg(F.min("first").alias("least")))
    least = stage(known.join(sized(whole, 40), "component").select("fp", "least"))
    return fps.join(sized(least, 48), "fp").select(
        ROW, "id", "fp", F.col("least.id").alias("component_id"), (F.col(f"least.{ROW}") == F.col(ROW)).alias("kept")
    )


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """One row per row of ``docs``: number, id, ``fp``, the least id of its component, and whether it is the row that stays."""
    fps = fingerprints(docs, id_col, text_col, width)
    order = F.struct(F.col("id").isNull().alias("none"), "id", ROW)
    first = stage(fps.groupBy("fp").agg(F.min(order).alias("first")))
    return grouped(fps, first, links(first))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """One row of each component, with all its columns. Texts do not move.

    ``docs`` is read twice (see ``placed``).
    """
    docs = placed(docs)
    dropped = stage(near_groups(docs, id_col, text_col, width).where("not kept").select(ROW))
    return docs.join(sized(dropped, 16), ROW, "left_anti").drop(ROW)
