"""Token ids as ORC files in ascending order of document ids, and their reader.

Texts are dealt to ranges of (doc_id, row), sorted, and encoded by the task
that writes them, so ids are written where they are made. A file's rows hold
the place of the document within its range; a document's place in the whole
is that plus the tokens of the ranges before, which are summed from the small
columns alone. Ids are written with ORC's integer run-length encoding, with
row indexes every ``Settings.index_rows`` rows and Bloom filters on the ids of
documents, so readers split files by stripes and skip stripes and row groups by
their metadata: filters on ``doc_id`` reach the scan.

The range of a row is decided by its number after its id, so many rows with
one id are spread over ranges as well.

Defined cases: a null or empty text has the end id only. Null ids come first.
Rows of equal ids keep the order in which they were read. An empty table gives
files without rows.
"""

from __future__ import annotations

import sys
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import ROW, numbered, shared_folder, sized, slices, stage
from marquee.llm.word_ids import Shared

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("part", T.IntegerType()), T.StructField("place", T.LongType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())),
])


@dataclass(frozen=True)
class Settings:
    end_id: int = 2
    stripe_bytes: int = 64 << 20
    index_rows: int = 1_000
    bloom_rate: float = 0.01


def new_folder(df: DataFrame) -> str:
    return f"{shared_folder(df).rstrip('/')}/marquee-tokens-{uuid.uuid4().hex}"


def write_tokens(docs: DataFrame, tokenizer: str, path: str, settings: Settings = Settings()) -> None:
    """Write the ids of each row's text, then ``end_id``, as ORC files below ``path``."""
    shared = Shared(docs.sparkSession, tokenizer)
    end = settings.end_id.to_bytes(4, "little")

    def task(batches):
        encode, part, place = shared.encoder(), TaskContext.get().partitionId(), 0
        for batch in slices(batches):
            packed = [encode(text) + end for text in batch.column(1).to_pylist()]
            n = np.array([len(p) // 4 for p in packed], np.int64)
            places = place + np.cumsum(n) - n
            place += int(n.sum())
            ends = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
            ids = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(packed), "<i4")))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([part] * len(n), pa.int32()), pa.array(places), pa.array(n), ids], FILES.names
            )

    rows = numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    ordered = rows.repartitionByRange("doc_id", ROW).sortWithinPartitions("doc_id", ROW)
    ordered.select("doc_id", "text").mapInArrow(task, FILES).write.options(**{
        "orc.stripe.size": settings.stripe_bytes, "orc.row.index.stride": settings.index_rows, "orc.create.index": "true",
        "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": settings.bloom_rate,
    }).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (tokens of all documents before), ``n_tokens`` and ``ids``."""
    files = spark.read.schema(FILES).orc(path)
    # One row per range of the writer, so few.
    totals = stage(files.groupBy("part").agg(F.sum("n_tokens").alias("n")))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sized(stage(totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))), 16)
    return files.join(offsets, "part").select("doc_id", (F.col("offset") + F.col("place")).alias("start"), "n_tokens", "ids")


def checksums(tokens: DataFrame) -> DataFrame:
    """``tokens`` with ``ids_crc32`` of the ids as little-endian unsigned 32-bit numbers in place of ``ids``."""
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "start", "n_tokens", "ids_crc32")])

    def task(batches):
        for batch in batches:
            lists = batch.column(3)
            at = lists.offsets.to_numpy()
            flat = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
            crcs = [zlib.crc32(flat[4 * a:4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crcs, pa.int64())], schema.names)

    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(task, schema)
