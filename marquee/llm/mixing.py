"""Mixing sources to target weights by Pfair scheduling.

Rows of a source are put in a random order fixed by a hash and cut into blocks.
Block k of a source with weight w may go out from k / w on, its release, and
must have gone out at (k + 1) / w, its deadline, on a clock that runs by the
weights of the sources that still have blocks. In each slot, the released block
with the earliest deadline goes. While all sources last, each has been given
its weight's share at every slot, to less than one block; when one runs out,
the others share its part by their weights.

Blocks are sized so that there are about ``Settings.blocks`` of them, whatever
the data: the schedule of all blocks is then a table of bounded size, worked
out once from counts and broadcast. Rows are numbered within their source from
the counts of hash ranges and their rank within a range, so no task holds a
source, however large. All is DataFrame functions but the schedule's own loop,
which sees no rows.

Defined cases: no row is dropped or repeated. A missing source is one more
source. Sources without a given weight, or all if none are given, weigh by the
square root of their rows. Sources of weight 0 come after all others. Ties of
deadlines go to the heavier source, then by name. Rows of equal id are told
apart by where they were read. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import ROW, placed, sized, stage


#: Name of the place while rows are put in order; no input column may have it.
PLACE = "_llm_place"


@dataclass(frozen=True)
class Settings:
    """blocks: about as many blocks as the schedule has; seed: of the order within sources."""

    blocks: int = 50_000
    least_range: int = 64
    seed: int = 17


def weights_of(counts: Mapping[str | None, int], given: Mapping[str | None, float] | None) -> dict[str | None, Fraction]:
    """Weight of each source, as an exact fraction; they need not add up to one."""
    given = given or {}
    if any(w < 0 for w in given.values()):
        raise ValueError("weights cannot be negative")
    return {
        s: Fraction(given[s]) if s in given else Fraction(math.isqrt(n << 20), 1 << 10)
        for s, n in counts.items()
    }


def schedule(blocks: Mapping[str | None, int], weights: Mapping[str | None, Fraction]) -> list[tuple[str | None, int]]:
    """(source, block) in the order of their slots, earliest released deadline first."""
    order = sorted(blocks, key=lambda s: (-weights[s], s is None, s or ""))
    rank = {s: i for i, s in enumerate(order)}
    active = {s for s in order if weights[s] > 0 and blocks[s] > 0}
    total = sum((weights[s] for s in active), Fraction(0))
    step = {s: float(1 / weights[s]) for s in active}
    waiting = [(0.0, rank[s], s, 0) for s in active]  # by release
    heapq.heapify(waiting)
    ready: list[tuple[float, int, str | None, int]] = []  # by deadline
    out: list[tuple[str | None, int]] = []
    now, rate = 0.0, float(total)
    while active:
        # A hair of slack, as releases are sums of floating-point steps.
        while waiting and waiting[0][0] <= now + 1e-9 / max(rate, 1e-300):
            _, r, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, ((k + 1) * step[s], r, s, k))
        if not ready:  # only after a source ran out early: the clock moves on to the next release
            now = waiting[0][0]
            continue
        _, r, s, k = heapq.heappop(ready)
        out.append((s, k))
        now += 1 / rate
        if k + 1 < blocks[s]:
            heapq.heappush(waiting, ((k + 1) * step[s], r, s, k + 1))
        else:
            active.discard(s)
            total -= weights[s]
            rate = float(total)
    for s in order:
        if weights[s] <= 0:
            out += [(s, k) for k in range(blocks[s])]
    return out


def mix(
    docs: DataFrame, weights: Mapping[str | None, float] | None = None, settings: Settings = Settings(),
    id_col: str = "doc_id", source_col: str = "source",
) -> DataFrame:
    """One narrow row per row of ``docs``: number, id, source, block, slot, and its place in the mixture, from 0.

    The order is the same on every reading of the same files (see ``placed``).
    """
    spark = docs.sparkSession
    rows = stage(
        placed(docs).select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), ROW)
        .withColumn("hash", F.xxhash64(F.lit(settings.seed), "id", ROW))
    )
    # One row per source. Mixing weights are set by source, so sources are few.
    counts = {r["source"]: r["count"] for r in rows.groupBy("source").count().collect()}
    total = sum(counts.values())
    size = max(1, -(-total // settings.blocks))
    wide = max(settings.least_range, 4 * size)

    # Ranges of the hash: about ``wide`` rows of a source each, so about total / wide ranges.
    ranges = F.broadcast(spark.createDataFrame(
        [(s, max(1, n // wide)) for s, n in counts.items()], "source string, ranges long"
    ))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    place = F.expr("cast(floor((hash / 18446744073709551616D + 0.5D) * ranges) as long)")
    dealt = rows.join(ranges, same(rows, ranges)).select(
        ROW, "id", rows["source"], "hash", F.least(place, F.col("ranges") - 1).alias("range")
    )
    # Counts of ranges add up to where each range begins. They are bounded by blocks / 4 and one per source.
    sums: dict[str | None, int] = {}
    starts = []
    for r in sorted(dealt.groupBy("source", "range").count().collect(), key=lambda r: (r["source"] or "", r["range"])):
        starts.append((r["source"], r["range"], sums.get(r["source"], 0)))
        sums[r["source"]] = sums.get(r["source"], 0) + r["count"]
    starts = F.broadcast(spark.createDataFrame(starts, "source string, range long, first long"))
    ranked = dealt.selectExpr(
        "*", f"row_number() over (partition by source, range order by hash, id, {ROW}) - 1 as rank"
    )
    ranked = ranked.join(starts, same(ranked, starts) & (ranked["range"] == starts["range"])).select(
        ROW, "id", ranked["source"], (F.col("first") + F.col("rank")).alias("nth")
    )
    blocks = {s: -(-n // size) for s, n in counts.items()}
    plan, before = [], 0
    for slot, (s, k) in enumerate(schedule(blocks, weights_of(counts, weights))):
        plan.append((s, k, slot, before))
        before += min(size, counts[s] - k * size)
    slots = F.broadcast(spark.createDataFrame(plan, "source string, block long, slot long, before long"))
    block = F.expr(f"nth div {size}")
    ranked = ranked.withColumn("block", block)
    return ranked.join(slots, same(ranked, slots) & (ranked["block"] == slots["block"])).select(
        ROW, "id", ranked["source"], ranked["block"], "slot", (F.col("before") + F.col("nth") % size).alias("position")
    )


def mixed_order(docs: DataFrame, weights: Mapping[str | None, float] | None = None, settings: Settings = Settings()) -> DataFrame:
    """``docs`` in the order of the mixture; written files keep it.

    ``docs`` is read twice (see ``placed``).
    """
    docs = placed(docs)
    places = stage(mix(docs, weights, settings).select(ROW, F.col("position").alias(PLACE)))
    return docs.join(sized(places, 24), ROW).orderBy(PLACE).drop(ROW, PLACE)
