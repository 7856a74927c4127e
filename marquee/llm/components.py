"""Connected components of a large graph, by alternating large-star and small-star steps.

Each step rewires every node to the least neighbour it knows of (Kiveris and
others, Connected Components in MapReduce and Beyond, 2014). The edges are the
only state; each step is written as a table, which cuts lineage. Node degrees
are combined before the shuffle, and the minima are written before they are
joined back, so Spark can split a node with very many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import sized, stage


def _least(pairs: DataFrame) -> DataFrame:
    return sized(stage(pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))), 16)


def _tidy(pairs: DataFrame) -> DataFrame:
    return stage(pairs.where("u <> v").distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _tidy(both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _tidy(moved.unionByName(least.select("u", F.col("m").alias("v"))))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, its least reachable node, for nodes that are not the least one.

    ``edges`` has two columns of comparable type; loops and repeated edges do
    not matter.
    """
    u, v = edges.columns
    now = _tidy(edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")))
    seen = _mark(now)
    while seen[0]:
        now = _small_star(_large_star(now))
        if (mark := _mark(now)) == seen:
            break
        seen = mark
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
