"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

Documents are tokenized and cut into pieces of at most ``Settings.capacity``
tokens. The pieces are dealt by hash, or in the order of the documents by
consecutive stretches (``pack_in_order``), to packing problems of some thousand
pieces, small enough for one task and large enough that a problem's last, half
empty sequence does not count. Each problem is worked on by several islands.

An island keeps a population of whole solutions, each a list of bins (groups of
pieces). A child is made by *injecting* whole well-filled bins of one parent
into the other: bins that hold one of the injected pieces are broken up, and
the displaced pieces are put back by best fit, longest first. Mutation breaks
up some badly filled bins in the same way. Fitness is the mean of the squared
fill, which prefers few full bins. After each epoch the islands' elites are
written as a table and migrate to the next island of the same problem, so lost
executors repeat one epoch at most.

A problem ends early if its bins are as few as the sum of lengths allows.

Defined cases: a null or empty text has the end id only; equal documents and
ids are packed each for itself; an empty table gives no rows. Every piece
appears once, at a place of its own, and sequences have no gaps.
"""

from __future__ import annotations

import sys
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import FILE_BITS, ROW, numbered, placed, slices, stage
from marquee.llm.word_ids import Shared

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Settings:
    """problem: pieces of one packing problem, about; islands, epochs, children: how long is searched;
    per_task: islands that a task works on."""

    capacity: int = 2048
    problem: int = 4096
    islands: int = 2
    epochs: int = 2
    population: int = 4
    children: int = 40
    elites: int = 2
    injected: float = 0.08
    per_task: int = 8
    seed: int = 7


PIECES = T.StructType([
    T.StructField(ROW, T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
])
ELITE = T.StructType([
    T.StructField("n_bins", T.IntegerType()), T.StructField("fitness", T.DoubleType()),
    T.StructField("bins", T.ArrayType(T.IntegerType())),
])
STATE = T.StructType([
    T.StructField("problem", T.LongType()), T.StructField("island", T.IntegerType()), T.StructField("elites", T.ArrayType(ELITE)),
])


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = 0) -> DataFrame:
    """The pieces of each row of ``docs``, written as a table; no token ids are moved."""
    shared = Shared(docs.sparkSession, tokenizer)
    end = end_id.to_bytes(4, "little")

    def task(batches):
        encode = shared.encoder()
        for batch in slices(batches):
            rows, ids, texts = (batch.column(i).to_pylist() for i in range(3))
            out = [[] for _ in PIECES.names]
            for row, doc_id, text in zip(rows, ids, texts, strict=True):
                packed = encode(text) + end
                for k, at in enumerate(range(0, len(packed), 4 * capacity)):
                    part = packed[at:at + 4 * capacity]
                    for column, value in zip(out, (row, doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], PIECES.names)

    rows = numbered(docs, F.col("doc_id").cast("long").alias("doc_id"), "text").select(ROW, "doc_id", "text")
    return stage(rows.mapInArrow(task, PIECES))


class Bins:
    """A packing: the pieces and the room left of each bin. Rooms are found by best fit."""

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.items: list[list[int]] = []
        self.room: list[int] = []

    @classmethod
    def of(cls, lengths, capacity, bin_of) -> Bins:
        self = cls(lengths, capacity)
        for item, b in enumerate(bin_of):
            while b >= len(self.items):
                self.items.append([])
                self.room.append(capacity)
            self.items[b].append(item)
            self.room[b] -= lengths[item]
        return self

    def put(self, displaced: list[int]) -> None:
        """Best fit, longest first (ties: by number)."""
        lengths, at, mask = self.lengths, {}, 0
        for b, room in enumerate(self.room):
            if room:
                at.setdefault(room, []).append(b)
                mask |= 1 << room
        for item in sorted(displaced, key=lambda i: -lengths[i]):
            need = lengths[item]
            fits = mask >> need
            if fits:
                room = need + (fits & -fits).bit_length() - 1
                same = at[room]
                b = same.pop()
                if not same:
                    mask ^= 1 << room
            else:
                b, room = len(self.items), self.capacity
                self.items.append([])
                self.room.append(room)
            self.items[b].append(item)
            self.room[b] = left = room - need
            if left:
                if not mask >> left & 1:
                    mask |= 1 << left
                    at[left] = []
                at[left].append(b)

    def fitness(self) -> float:
        fill = 1 - np.array(self.room) / self.capacity
        return float((fill * fill).mean()) if len(fill) else 1.0

    def bin_of(self) -> list[int]:
        out = [0] * len(self.lengths)
        for b, items in enumerate(self.items):
            for item in items:
                out[item] = b
        return out

    def without(self, broken: set[int]) -> tuple[Bins, list[int]]:
        """The packing with some bins taken out, and what was in them."""
        left = Bins(self.lengths, self.capacity)
        displaced = []
        for b, items in enumerate(self.items):
            if b in broken:
                displaced += items
            else:
                left.items.append(list(items))
                left.room.append(self.room[b])
        return left, displaced


def best_fit(lengths: list[int], capacity: int, order: list[int] | None = None) -> Bins:
    bins = Bins(lengths, capacity)
    bins.put(list(range(len(lengths))) if order is None else order)
    return bins


def crossover(one: Bins, other: Bins, share: float, draw: np.random.Generator) -> Bins:
    """``one`` with some of the best-filled bins of ``other`` injected whole."""
    n = max(1, int(share * len(other.items)))
    good = np.argsort(np.array(other.room), kind="stable")[: max(n, len(other.room) // 2)]
    chosen = draw.choice(good, size=min(n, len(good)), replace=False).tolist()
    injected = {item for b in chosen for item in other.items[b]}
    broken = {b for b, items in enumerate(one.items) if not injected.isdisjoint(items)}
    child, displaced = one.without(broken)
    for b in chosen:
        child.items.append(list(other.items[b]))
        child.room.append(other.room[b])
    child.put([i for i in displaced if i not in injected])
    return child


def mutated(one: Bins, share: float, draw: np.random.Generator) -> Bins:
    """``one`` with its emptiest bins and some others broken up and packed again."""
    n = max(2, int(share * len(one.items) / 2))
    emptiest = np.argsort(-np.array(one.room), kind="stable")[:n].tolist()
    others = draw.choice(len(one.items), size=min(n, len(one.items)), replace=False).tolist()
    child, displaced = one.without({*emptiest, *others})
    # Put most back in a changed order, as the same order would give the same bins.
    draw.shuffle(displaced)
    half = len(displaced) // 2
    child.put(displaced[:half])
    child.put(displaced[half:])
    return child


def evolve(lengths: list[int], seeds: list[list[int]], settings: Settings, island: int, epoch: int) -> list[Bins]:
    """The elites of one island after one epoch. ``lengths`` are all below the capacity."""
    cap = settings.capacity
    draw = np.random.default_rng([settings.seed, island, epoch, len(lengths)])
    population = [Bins.of(lengths, cap, s) for s in seeds]
    if not population:
        population.append(best_fit(lengths, cap))
    bound = -(-sum(lengths) // cap)
    key = lambda b: (len(b.items), -b.fitness())
    if len(population[0].items) > bound:
        while len(population) < settings.population:
            half = draw.permutation(len(lengths))[: len(lengths) // 2].tolist()
            fresh = best_fit(lengths, cap, half)
            fresh.put(sorted(set(range(len(lengths))).difference(half)))
            population.append(fresh)
        population.sort(key=key)
        for _ in range(settings.children):
            if len(population[0].items) <= bound:
                break
            a, b = sorted(draw.choice(len(population), 2, replace=False).tolist())
            child = crossover(population[a], population[b], settings.injected, draw)
            if draw.random() < 0.5:
                child = mutated(child, settings.injected, draw)
            if key(child) < key(population[-1]):
                population[-1] = child
                population.sort(key=key)
    return sorted(population, key=key)[: settings.elites]


def in_order(pieces: DataFrame, n_problems: int, most: int = 50_000) -> DataFrame:
    """``pieces`` with ``problem``: equal stretches of them in the order of row number and piece.

    Numbers leave gaps, between files and where rows were dropped. So ranges of
    ``2 ** wide`` numbers are counted, as fine as about ``most`` ranges allow,
    and only the pieces of a range are ranked together.
    """
    spans = pieces.groupBy(F.shiftright(ROW, FILE_BITS)).agg((F.max(ROW) - F.min(ROW)).alias("span")).agg(F.sum("span")).first()[0]
    wide = max(6, ((spans or 0) // most).bit_length())
    ranged = pieces.withColumn("range", F.shiftright(ROW, wide))
    starts, before = [], 0
    for r in sorted(ranged.groupBy("range").count().collect(), key=lambda r: r["range"]):
        starts.append((r["range"], before))
        before += r["count"]
    starts = F.broadcast(pieces.sparkSession.createDataFrame(starts, "range long, first long"))
    ranked = ranged.selectExpr("*", f"row_number() over (partition by range order by {ROW}, piece) - 1 as rank").join(starts, "range")
    size = max(1, -(-before // n_problems))
    return ranked.select(*pieces.columns, F.expr(f"(first + rank) div {size}").alias("problem"))


def pack(pieces: DataFrame, settings: Settings = Settings(), ordered: bool = False) -> DataFrame:
    """``pieces`` (staged, columns of ``PIECES``) with ``sequence_id`` and ``offset``.

    If ``ordered``, problems are stretches of the pieces in the order of their
    row numbers, and sequences are numbered by problem in that order.
    """
    n_problems = max(1, round(pieces.count() / settings.problem))
    # The hash deals single pieces, so every problem gets about as many, whatever the ids are.
    problem = F.pmod(F.xxhash64(ROW, "piece"), F.lit(n_problems))
    dealt = in_order(pieces, n_problems) if ordered else pieces.withColumn("problem", problem)
    item = F.struct(ROW, "piece", "doc_id", "start", "length", "ids_crc32")
    problems = stage(
        dealt.groupBy("problem").agg(F.sort_array(F.collect_list(item)).alias("items"))
    )
    lengths = problems.select("problem", F.col("items.length").alias("lengths"))
    islands = F.explode(F.sequence(F.lit(0), F.lit(settings.islands - 1))).alias("island")

    def epoch_of(epoch: int):
        def task(batches):
            for batch in batches:
                rows, out = [], []
                for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                    rows.append((row["problem"], row["island"]))
                    small = [i for i, x in enumerate(row["lengths"]) if x < settings.capacity]
                    of = [row["lengths"][i] for i in small]
                    seeds = [e["bins"] for e in row["elites"] or []]
                    best = evolve(of, seeds, settings, row["island"], epoch)
                    out.append([{"n_bins": len(b.items), "fitness": b.fitness(), "bins": b.bin_of()} for b in best])
                yield pa.RecordBatch.from_arrays([
                    pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                    pa.array(out, pa.list_(pa.struct([
                        ("n_bins", pa.int32()), ("fitness", pa.float64()), ("bins", pa.list_(pa.int32()))
                    ]))),
                ], STATE.names)

        return task

    state = None
    for epoch in range(settings.epochs):
        if state is None:
            rows = lengths.select("problem", islands, "lengths", F.lit(None).cast(STATE["elites"].dataType).alias("elites"))
        else:
            # Each island keeps its elites and gets the best one of the island before it.
            guests = state.select(
                "problem", ((F.col("island") + 1) % settings.islands).alias("island"), F.slice("elites", 1, 1).alias("guest")
            )
            own = state.join(guests, ["problem", "island"]).select("problem", "island", F.concat("elites", "guest").alias("elites"))
            rows = lengths.join(own, "problem").select("problem", "island", "lengths", "elites")
        deal = rows.repartition(-(-n_problems * settings.islands // settings.per_task), "problem", "island")
        state = stage(deal.mapInArrow(epoch_of(epoch), STATE))
    best = state.select("problem", F.explode("elites").alias("e")).groupBy("problem").agg(
        F.max_by("e.bins", F.struct(-F.col("e.n_bins"), F.col("e.fitness"))).alias("bins")
    )
    return problems.join(best, "problem").mapInArrow(
        _layout(settings.capacity), T.StructType([*PIECES.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    )


def _layout(capacity: int):
    """Places in the sequences, from each problem's bins; full pieces have a sequence each."""

    def task(batches):
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                used: dict[int, int] = {}
                bins, n = iter(row["bins"] or []), len(row["items"])
                out = {name: [] for name in [*PIECES.names, "sequence_id", "offset"]}
                for k, item in enumerate(row["items"]):
                    b = n + k if item["length"] >= capacity else next(bins)
                    for name in PIECES.names:
                        out[name].append(item[name])
                    out["sequence_id"].append(row["problem"] << 32 | b)
                    out["offset"].append(used.get(b, 0))
                    used[b] = used.get(b, 0) + item["length"]
                kinds = {"piece": pa.int32()}
                yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()], list(out))

    return task


def pack_documents(docs: DataFrame, tokenizer: str, settings: Settings = Settings()) -> DataFrame:
    return pack(pieces_of(docs, tokenizer, settings.capacity), settings).drop(ROW)


def pack_in_order(docs: DataFrame, tokenizer: str, settings: Settings = Settings()) -> DataFrame:
    """As ``pack_documents``, but sequences follow the order of ``docs`` in their files, by stretches of about ``problem`` pieces."""
    return pack(pieces_of(placed(docs), tokenizer, settings.capacity), settings, ordered=True).drop(ROW)
