"""Near duplicates by MinHash: banded universal hash minima, checked signatures, exact sets, components by star steps.

Each text becomes the set of its shingles of ``Settings.width`` words. Texts of
equal sets are one node. A node's signature holds ``bands * rows`` minima under
functions drawn from a strongly universal family (multiply, add, shift); nodes
with one band of minima in common share a bucket. A pair of similarity s shares
one with probability ``1 - (1 - s ** rows) ** bands``: 0.99996 at 0.85, and more
above. Before any set is fetched, a candidate pair is verified by the lowest
bits of its minima, whose number of differences tells the similarity to a few
hundredths; pairs within ``Settings.slack`` deviations of the threshold stay.
Every link is confirmed on the whole sets.

A bucket of m nodes has m * m / 2 pairs, but only those matter that join two
components, so a bucket's pairs are never all listed:

* each node is compared with the least node of its bucket and with the one
  before it (buckets are cut into stretches of bounded size for that);
* of the nodes whose buckets then still hold several components, shingles are
  ordered by how many of these nodes have them. Similar sets have one of their
  rarest shingles in common, and what comes after it bounds all that they can
  have in common. So nodes meet at their rarest shingles, and only pairs of
  different components whose bound and signature allow the threshold are
  compared. Nothing is left out by that, and nodes that share frequent shingles
  only do not meet.

Defined cases: A-Z are lower-cased, words are runs of other than space and tab
to carriage return. A text with fewer words is one shingle. A text without
words, or null, is linked with nothing, not even its like. Null ids are larger
than all others; of equal ids the row read first stays. An empty table gives no
rows. Other columns do not matter, but for those that begin with ``_llm_``.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import ROW, as_bytes, numbered, placed, sized, slices, stage
from marquee.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words whose hashes a task remembers.
MEMO = 300_000
#: Nodes of a bucket that are put in order at once.
STRETCH = 1_024


@dataclass(frozen=True)
class Settings:
    """width: words of a shingle; least: linked similarity in hundredths; bands of rows minima; slack: deviations that a signature may be off."""

    width: int = 5
    least: int = 85
    bands: int = 32
    rows: int = 8
    slack: float = 5.0
    seed: int = 11

    @property
    def minima(self) -> int:
        return self.bands * self.rows

    @property
    def words(self) -> int:
        """64-bit words of a sketch, which has one bit of each minimum."""
        return -(-self.minima // 64)

    @property
    def most_apart(self) -> int:
        """Bits in which the sketches of two nodes may differ that are similar enough."""
        unlike = (1 - self.least / 100) / 2
        return math.ceil(self.minima * unlike + self.slack * math.sqrt(self.minima * unlike * (1 - unlike)))


class Shingles(dict):
    """Hashes of words, filled when first asked for; called with a text it gives the sorted set of its shingles' hashes."""

    def __init__(self, width: int):
        super().__init__()
        self.width = width

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word, 42)
        if len(word) < 64 and len(self) < MEMO:
            self[word] = found
        return found

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        hashes = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        k = min(self.width, len(words))
        n = len(words) - k + 1
        found = np.full(n, k, np.uint64)
        for i in range(k):
            found = (found ^ hashes[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
            found ^= found >> np.uint64(29)
        return np.unique(found)


def functions(settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Factors and terms of the hash functions."""
    draw = np.random.default_rng(settings.seed)
    return tuple(draw.integers(0, 1 << 64, settings.minima, np.uint64) for _ in range(2))


def signatures_of(sets: list[np.ndarray], drawn: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The minima of each set, which must not be empty: one row of unsigned 32-bit numbers for each."""
    keys = np.concatenate(sets) & np.uint64(0xFFFFFFFF)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), len(drawn[0])), np.uint32)
    hashed = np.empty_like(keys)
    for k, (factor, term) in enumerate(zip(*drawn, strict=True)):
        np.multiply(keys, factor, out=hashed)
        np.add(hashed, term, out=hashed)
        out[:, k] = np.minimum.reduceat(hashed, starts) >> np.uint64(32)
    return out


def bands_of(minima: np.ndarray, settings: Settings) -> np.ndarray:
    """A 64-bit hash of each band of each row of minima."""
    cells = minima.reshape(len(minima), settings.bands, settings.rows).astype(np.uint64)
    found = np.broadcast_to(np.arange(1, settings.bands + 1, dtype=np.uint64), cells.shape[:2]).copy()
    for i in range(settings.rows):
        found = (found ^ cells[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
        found ^= found >> np.uint64(31)
    return found.view(np.int64)


def sketches_of(minima: np.ndarray, settings: Settings) -> np.ndarray:
    """The lowest bits of each row of minima, as 64-bit words."""
    bits = np.packbits((minima & 1).astype(np.uint8), axis=1, bitorder="little")
    padded = np.zeros((len(minima), 8 * settings.words), np.uint8)
    padded[:, :bits.shape[1]] = bits
    return padded.view("<i8")


def signatures(docs: DataFrame, id_col: str, text_col: str, settings: Settings) -> DataFrame:
    """Number, id, size ``n`` and 128-bit hash ``fp`` of the set, ``bands`` and ``sketch`` of each row, written as a table."""
    rows = numbered(docs, F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def lists(table: np.ndarray, full: np.ndarray, total: int) -> pa.ListArray:
        lengths = np.zeros(total, np.int64)
        lengths[full] = table.shape[1]
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(table.ravel()))

    def task(batches):
        shingles, drawn = Shingles(settings.width), functions(settings)
        for batch in slices(batches, 2 << 20):
            sets = [shingles(text) for text in as_bytes(batch.column(2))]
            full = np.array([k for k, s in enumerate(sets) if len(s)], np.int64)
            minima = signatures_of([sets[k] for k in full], drawn) if len(full) else np.zeros((0, settings.minima), np.uint32)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                lists(bands_of(minima, settings), full, len(sets)), lists(sketches_of(minima, settings), full, len(sets)),
            ], [ROW, "id", "n", "fp", "bands", "sketch"])

    schema = T.StructType([
        T.StructField(ROW, T.LongType()), T.StructField("id", rows.schema["id"].dataType), T.StructField("n", T.LongType()),
        T.StructField("fp", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType())),
        T.StructField("sketch", T.ArrayType(T.LongType())),
    ])
    return stage(rows.select(ROW, "id", "text").mapInArrow(task, schema))


def sets_of(docs: DataFrame, wanted: DataFrame, text_col: str, settings: Settings) -> DataFrame:
    """``node`` and the whole ``set`` of the rows whose number is a ``node`` of ``wanted``, written as a table."""
    rows = numbered(docs, F.col(text_col).alias("text")).withColumnRenamed(ROW, "node").join(sized(wanted, 16), "node")

    def task(batches):
        shingles = Shingles(settings.width)
        for batch in slices(batches, 2 << 20):
            found = [shingles(text).view(np.int64) for text in as_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["node", "set"])

    return stage(rows.select("node", "text").mapInArrow(task, "node long, set array<long>"))


def confirmed(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """The ``pairs`` (a, b) whose whole sets are similar enough, written as a table."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("set").alias("y")), "b"
    )
    common = both.selectExpr("a", "b", "size(array_intersect(x, y)) as i", "size(x) + size(y) as n")
    return stage(common.where(f"100 * i >= {settings.least} * (n - i)").select("a", "b"))


def _apart(settings: Settings) -> str:
    """Differing bits of the sketches of ``l`` and ``r``."""
    return " + ".join(f"bit_count(l.s{k} ^ r.s{k})" for k in range(settings.words))


def _allowed(common: str, settings: Settings) -> str:
    """Whether ``l`` and ``r``, with at most ``common`` shingles in common, can be similar enough."""
    return f"100 * {common} >= {settings.least} * (l.n + r.n - {common})"


def links(docs: DataFrame, nodes: DataFrame, text_col: str, settings: Settings) -> DataFrame:
    """Pairs ``a``, ``b`` of ``nodes`` (node, n, bands, sketch) that are linked and connect all that are linked."""
    facts = sized(stage(nodes.select("node", "n", *(F.col("sketch")[k].alias(f"s{k}") for k in range(settings.words)))), 24 + 8 * settings.words)
    bucket = nodes.select("node", F.explode("bands").alias("bucket"))
    tally = stage(bucket.groupBy("bucket").agg(F.count("*").alias("many"), F.min("node").alias("first")).where("many > 1"))
    shared = stage(bucket.join(sized(tally, 24), "bucket"))
    stretch = f"partition by bucket, pmod(xxhash64(node), (many - 1) div {STRETCH} + 1) order by node"
    before = shared.selectExpr("node", f"lag(node) over ({stretch}) as other").where("other is not null")
    first = shared.where("first <> node").selectExpr("node", "first as other")
    asked = stage(before.unionByName(first).selectExpr("least(node, other) as a", "greatest(node, other) as b").distinct())
    left, right = facts.alias("l"), facts.alias("r")
    alike = asked.join(left, F.col("a") == F.col("l.node")).join(right, F.col("b") == F.col("r.node"))
    alike = stage(alike.where(f"{_allowed('least(l.n, r.n)', settings)} and {_apart(settings)} <= {settings.most_apart}").select("a", "b"))
    sets = sets_of(docs, stage(shared.select("node").distinct()), text_col, settings)
    found = confirmed(alike, sets, settings)

    joined = sized(stage(components(found)), 16)
    parts = stage(
        shared.select("bucket", "node").join(joined.select("node", "component"), "node", "left")
        .select("bucket", "node", F.coalesce("component", "node").alias("part"))
    )
    several = parts.groupBy("bucket").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p <> q").select("bucket")
    open_ = parts.join(sized(stage(several), 8), "bucket", "left_semi")
    asked = stage(open_.select("node", "part").distinct())
    # The rarest shingles of the nodes that may still get links, as many as two similar sets cannot both lack in common.
    spread = sets.join(sized(asked, 16), "node").select("node", F.size("set").alias("n"), F.explode("set").alias("shingle"))
    known = stage(spread.groupBy("shingle").agg(F.count("*").alias("k")))
    rarest = Window.partitionBy("node").orderBy("k", "shingle")
    first = (
        spread.join(known, "shingle").withColumn("at", F.row_number().over(rarest) - 1)
        .where(f"k > 1 and at <= n - ({settings.least} * n + 99) div 100").select("shingle", "node", "at")
    )
    first = stage(first.join(sized(asked, 16), "node").join(facts, "node"))
    enough = (
        f"({100 + settings.least}) * least(l.n - l.at, r.n - r.at) >= {settings.least} * (l.n + r.n)"
        f" and {_apart(settings)} <= {settings.most_apart}"
    )
    rest = first.alias("l").join(first.alias("r"), F.expr(
        f"l.shingle = r.shingle and l.node < r.node and l.part <> r.part and {enough}"
    )).selectExpr("l.node as a", "r.node as b").distinct()
    rest = stage(rest.join(alike, ["a", "b"], "left_anti"))
    return found.unionByName(confirmed(rest, sets, settings))


def similar_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()
) -> DataFrame:
    """One row per row of ``docs``: number, id, size ``n`` of its set, the least id of its component, and whether it is the row that stays.

    ``docs`` is read twice (see ``placed``).
    """
    docs = placed(docs)
    rows = signatures(docs, id_col, text_col, settings)
    order = F.struct(F.col("id").isNull().alias("none"), "id", ROW)
    full = rows.where("n > 0")
    nodes = stage(
        full.groupBy("fp").agg(
            F.min(order).alias("least"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")
        ).withColumn("node", F.col(f"least.{ROW}"))
    )
    joined = sized(stage(components(links(docs, nodes, text_col, settings))), 16)
    known = stage(
        nodes.select("fp", "least", F.col("node").alias("at")).join(joined, F.col("at") == F.col("node"), "left")
        .select("fp", "least", F.coalesce("component", "at").alias("component"))
    )
    whole = stage(known.groupBy("component").agg(F.min("least").alias("least")))
    least = stage(known.select("fp", "component").join(sized(whole, 40), "component").select("fp", "least"))
    linked = full.select(ROW, "id", "n", "fp").join(sized(least, 48), "fp").select(
        ROW, "id", "n", F.col("least.id").alias("component_id"), (F.col(f"least.{ROW}") == F.col(ROW)).alias("kept")
    )
    return linked.unionByName(
        rows.where("n = 0").select(ROW, "id", "n", F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    )


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row of each component, with all its columns. Texts do not move.

    ``docs`` is read three times (see ``placed``).
    """
    docs = placed(docs)
    dropped = stage(similar_groups(docs, id_col, text_col, settings).where("not kept").select(ROW))
    return docs.join(sized(dropped, 16), ROW, "left_anti").drop(ROW)
