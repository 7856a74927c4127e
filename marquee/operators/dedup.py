"""Duplicates and ranking: keep the last row, report duplicates, top rows per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.operators.joins import HOT_ROWS, semi_join_spread


def keep_last(
    df: DataFrame,
    key: str = "id",
    order: Sequence[str] = ("src_year", "_src_file", "_src_pos"),
    keep_null: bool = False,
) -> DataFrame:
    """The last row per key in the given total order.

    Missing keys form one group and collapse to one row, unless ``keep_null``.
    The ``== 1`` filter is pushed below the shuffle by Spark, so each task
    sends at most one row per key and a hot key stays cheap.
    """
    k = F.col(f"`{key}`")
    partition: list[Column] = [k]
    if keep_null:
        # Each keyless row is a group of its own.
        partition.append(F.when(k.isNull(), F.monotonically_increasing_id()))
    newest = Window.partitionBy(*partition).orderBy(
        *(F.col(f"`{c}`").desc_nulls_last() for c in order)
    )
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def duplicate_titles(
    df: DataFrame, key: str = "id", show: str = "title", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Distinct titles of every key that occurs more than once, one per row.

    The long form of the report, for keys with too many titles for one cell.
    """
    from marquee.sinks.staging import stage

    k, s = f"`{key}`", f"`{show}`"
    pairs = stage(df.filter(F.col(k).isNotNull()).groupBy(k, s).agg(F.count(F.lit(1)).alias("_rows")))
    keys = stage(pairs.groupBy(k).agg(F.count(s).alias("count"), F.sum("_rows").alias("_rows")))
    titles = pairs.filter(F.col(s).isNotNull()).select(k, s)
    return semi_join_spread(titles, keys, keys.filter("_rows > 1"), key, hot_rows=hot_rows)


def duplicate_report(df: DataFrame, key: str = "id", show: str = "title") -> DataFrame:
    """Keys that occur more than once, their row count, and their titles.

    Columns: key, ``count``, ``titles`` (distinct, sorted, joined by ``', '``).
    Rows are first counted per key and title, which spreads a hot key over
    its titles and leaves only distinct titles to gather.
    """
    k, s = F.col(f"`{key}`"), F.col(f"`{show}`")
    return (
        df.filter(k.isNotNull())
        .groupBy(k.alias(key), s.alias("_s"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy(key)
        .agg(
            F.sum("_n").alias("count"),
            F.array_join(F.sort_array(F.collect_list("_s")), ", ").alias("titles"),
        )
        .filter("count > 1")
    )


#: Bytes of titles in one piece of the report.
PIECE_BYTES = 1 << 20


def duplicate_pieces(
    df: DataFrame, key: str = "id", show: str = "title", piece_bytes: int = PIECE_BYTES, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """The duplicate report with an id's titles in pieces of bounded size: key, ``piece`` from 0, ``count``, ``titles``.

    Rows are ``duplicate_report``'s but for ids with more than ``piece_bytes``
    of titles: theirs are cut where the running size of the sorted titles, with
    their separators, passes a multiple of it. Titles are sorted in ranges of
    key and title, so an id with very many is spread over ranges. Sizes are
    added up within a range, and ranges of an id by their totals.
    """
    from marquee.sinks.staging import stage

    k = f"`{key}`"
    pairs = stage(
        df.filter(F.col(k).isNotNull()).groupBy(F.col(k).alias("_of"), F.col(f"`{show}`").alias("_title"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    keys = stage(pairs.groupBy("_of").agg(F.sum("count").alias("count"), F.count("_title").alias("_titles")).filter("count > 1"))
    own = pairs.filter(F.col("_title").isNotNull()).select("_of", "_title")
    sizes = keys.select("_of", F.col("_titles").alias("count"))
    ranges = (
        semi_join_spread(own, sizes, keys, "_of", hot_rows=hot_rows)
        .repartitionByRange("_of", "_title")
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_size", F.octet_length("_title").cast("long") + 2)
    )
    ranges = stage(ranges)  # a row keeps the range that it was sorted into
    upto = Window.partitionBy("_of").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = ranges.groupBy("_of", "_range").agg(F.sum("_size").alias("_total")).select(
        "_of", "_range", F.coalesce(F.sum("_total").over(upto), F.lit(0)).alias("_before")
    )
    running = Window.partitionBy("_of", "_range").orderBy("_title").rowsBetween(Window.unboundedPreceding, 0)
    pieces = (
        ranges.withColumn("_upto", F.sum("_size").over(running) - F.col("_size"))
        .join(stage(before), ["_of", "_range"])
        .withColumn("piece", F.expr(f"(_before + _upto) div {piece_bytes}"))
        .groupBy("_of", "piece").agg(F.array_join(F.sort_array(F.collect_list("_title")), ", ").alias("titles"))
    )
    return keys.join(pieces, "_of", "left").select(
        F.col("_of").alias(key), F.coalesce("piece", F.lit(0)).alias("piece"), "count", F.coalesce("titles", F.lit("")).alias("titles")
    )


def all_duplicates(df: DataFrame, c: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every row whose value in ``c`` occurs more than once; NULL is a value.

    Counts are combined before the shuffle and joined back, rather than
    counted in a window, which would hold a hot value in one task.
    """
    from marquee.sinks.staging import stage

    counts = stage(df.groupBy(f"`{c}`").count())
    return semi_join_spread(df, counts, counts.filter("count > 1"), c, hot_rows=hot_rows)


def top_per_group(
    df: DataFrame,
    group: str | Sequence[str],
    order: Sequence[Column],
    n: int = 600,
    parts: int | None = None,
) -> DataFrame:
    """The first ``n`` rows per group in the given order.

    Ranks within parts of each group first, then among the at most
    ``n * parts`` rows that are left, so no group is sorted by one task. There
    are as many parts as shuffle partitions by default, so they grow with the
    job.
    """
    if parts is None:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = [group] if isinstance(group, str) else list(group)

    def ranked(rows: DataFrame, by: list[str]) -> DataFrame:
        window = Window.partitionBy(*(F.col(f"`{c}`") for c in by)).orderBy(*order)
        return rows.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")

    split = df.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(parts)))
    return ranked(ranked(split, [*groups, "_part"]).drop("_part"), groups)
