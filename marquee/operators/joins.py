"""Joins: listing with details, pages of a listing, lookup in a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot from this many rows on: below it one task copes.
HOT_ROWS = 1_000_000
# Nor is it hot with less than this part of all rows. So there are at most this
# many hot keys, all of them are spread, and the broadcast set is bounded.
HOT_KEYS = 100_000
# Links are broadcast up to this size in all.
BROADCAST_BYTES = 64 * 1024 * 1024


def merge_details(
    listing: DataFrame,
    details: DataFrame,
    on: str = "Movie Link",
    per_year: bool = True,
    null_safe: bool = False,
) -> DataFrame:
    """Inner join of listing and details; duplicate links give all pairs.

    The details key may be called ``link``. ``per_year`` joins within
    ``src_year`` only. ``null_safe`` lets missing links match each other.
    Both sides are shuffled directly, so adaptive execution can broadcast a
    small side or split a hot link on either side.
    """
    if on not in details.columns:
        details = details.withColumnRenamed("link", on)
    keys = ["src_year", on] if per_year else [on]
    if not null_safe:
        return listing.join(details, keys, "inner")
    left, right = listing.alias("l"), details.alias("r")
    cond = F.lit(True)
    for key in keys:
        cond = cond & F.col(f"l.`{key}`").eqNullSafe(F.col(f"r.`{key}`"))
    rest = [F.col(f"r.`{c}`") for c in details.columns if c not in keys]
    first = [F.col(f"l.`{c}`") for c in keys]
    other = [F.col(f"l.`{c}`") for c in listing.columns if c not in keys]
    return left.join(right, cond, "inner").select(*first, *other, *rest)


def hot_parts(counts: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``_hot_key`` and ``_parts``, one part for each ``hot_rows`` of its rows, of the keys in ``counts`` with so many or more.

    With many rows a part has more, so that there are at most ``HOT_KEYS`` hot keys.
    """
    total = counts.agg(F.sum("count")).first()[0] or 0
    least = max(hot_rows, total // HOT_KEYS)
    return counts.filter(F.col("count") >= least).select(
        F.col(f"`{key}`").alias("_hot_key"), F.ceil(F.col("count") / least).cast("int").alias("_parts")
    )


def semi_join_spread(
    df: DataFrame, counts: DataFrame, distinct_keys: DataFrame, key: str, *, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``distinct_keys``; NULL matches NULL.

    ``counts`` holds ``(key, count)`` of ``df``. Adaptive skew handling does
    not reach a join with an aggregated side, so a hot key gets one part for
    each ``hot_rows`` of its rows. The rows are dealt to the parts by their
    content, and the one matching key row is repeated for every part: all keys
    together at most ``rows / hot_rows`` times more than there are keys. All
    other rows stay in part 0.
    """
    k = f"`{key}`"
    hot = F.broadcast(hot_parts(counts, key, hot_rows))  # at most HOT_KEYS rows

    def flagged(side: DataFrame) -> DataFrame:
        return side.join(hot, side[key].eqNullSafe(hot["_hot_key"]), "left").drop("_hot_key")

    # The task counts as well, so that rows of equal content are spread too. Maps cannot be hashed.
    content = F.xxhash64(*(F.col(f"`{c}`") for c, dtype in df.dtypes if "map<" not in dtype)) + F.spark_partition_id()
    part = F.when(F.col("_parts") > 1, F.pmod(content, F.col("_parts"))).otherwise(0).cast("int")
    left = flagged(df).withColumn("_part", part).drop("_parts")
    every = F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)
    right = flagged(distinct_keys.select(k)).select(
        F.col(k).alias("_key"), F.explode(every).alias("_key_part")
    )
    cond = F.col(k).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_key_part"))
    return left.join(right, cond, "left_semi").drop("_part")


def restrict_pages(
    pages: DataFrame,
    listing: DataFrame,
    on: str = "Movie Link",
    url: str = "url",
    max_broadcast: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Pages whose URL is a link of the listing, of the same ``src_year`` if both have one. Run it before extraction.

    The size of the distinct links is measured first, by a job over the
    listing that writes them. Up to ``max_broadcast`` bytes they are broadcast and no page
    moves. Above that pages are shuffled once, with hot URLs spread.
    """
    present = pages.filter(F.col(f"`{url}`").isNotNull())
    year = ["src_year"] if "src_year" in pages.columns and "src_year" in listing.columns else []
    from marquee.sinks.staging import stage

    links = stage(listing.select(*year, F.col(f"`{on}`").alias(url)).filter(F.col(url).isNotNull()).distinct())
    size = links.agg(F.sum(F.octet_length(F.col(url).cast("string")) + 40)).first()[0] or 0
    same = present[url] == links[url]
    for c in year:
        same &= present[c].eqNullSafe(links[c])
    if size <= max_broadcast:
        return present.join(F.broadcast(links), same, "left_semi")
    link = F.struct(*year, F.col(url)).alias("_link")
    present, links = present.withColumn("_link", link), links.select(link)
    counts = stage(present.groupBy("_link").count())
    return semi_join_spread(present, counts, links, "_link", hot_rows=hot_rows).drop("_link")


def lookup(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    default: dict[str, object],
    dim_key: str | None = None,
    max_broadcast: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left join with a table of values; absent keys take the default values.

    The table is broadcast only while its values take at most ``max_broadcast``
    bytes. Above that it is joined by shuffle, and adaptive execution splits hot
    keys.
    """
    dim_key = dim_key or key
    columns: Sequence[str] = [c for c in dim.columns if c != dim_key]
    table = dim.withColumnRenamed(dim_key, "_dim_key")
    size = dim.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    if size <= max_broadcast:
        table = F.broadcast(table)
    filled: list[Column] = [
        F.coalesce(F.col(f"`{c}`"), F.lit(default[c])).alias(c) if c in default else F.col(f"`{c}`")
        for c in columns
    ]
    joined = df.join(table, df[key] == table["_dim_key"], "left")
    return joined.select(*(df[c] for c in df.columns), *filled)
