"""Exact duplicates of normalised texts, found by two passes over a Bloom filter.

The first pass counts hashes into the slots of a Bloom filter and keeps the
bits of slots that were hit twice or more. The second pass looks each row up:
a row whose bit is not set has a text of its own and passes straight through,
without a shuffle. Only rows whose bit is set are grouped by their digest, so
a false positive costs a little shuffle and never a wrong result.

Everything is DataFrame functions. Texts are read once; all that moves is a
digest and an id. The filter is a table of 64-bit words, so it can be larger
than one machine: it is broadcast only if its counted size fits.

Defined cases: a null text counts as empty; texts are equal if they are
identical after each run of blanks (space, tab to carriage return) became one
space. The smallest doc_id stays; null ids come last; of equal ids in one
group the row read first stays. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import ROW, empty_text, numbered, placed, sized, stage

#: Slots of the filter for each row; about 1 in so many unique rows is grouped needlessly.
SLOTS_PER_ROW = 32


def normal_text(text: Column) -> Column:
    return F.regexp_replace(empty_text(text), r"[\x20\x09-\x0D]+", " ")


def _slot(slots: int) -> Column:
    return F.pmod(F.xxhash64("sha"), F.lit(slots))


def repeated_bits(digests: DataFrame, slots: int) -> DataFrame:
    """The filter: ``word``, and the ``bits`` of its 64 slots that two or more rows fall into."""
    hit = digests.select(_slot(slots).alias("slot")).groupBy("slot").count().where("count > 1")
    return hit.groupBy(F.expr("shiftright(slot, 6)").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("bits")
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row per row of ``docs``: its number, id, digest, the id kept of its group, the group's size, kept."""
    digests = stage(
        numbered(docs, F.col(id_col).alias("id"), F.sha2(normal_text(F.col(text_col)), 256).alias("sha"))
    )
    slots = max(64, digests.count() * SLOTS_PER_ROW)
    bits = sized(stage(repeated_bits(digests, slots)), 16)
    looked = (
        digests.withColumn("slot", _slot(slots))
        .withColumn("word", F.expr("shiftright(slot, 6)"))
        .join(bits, "word", "left")
        .withColumn("again", F.expr("coalesce(shiftright(bits, cast(slot & 63 as int)) & 1, 0) = 1"))
    )
    order = F.struct(F.col("id").isNull().alias("none"), "id", ROW)
    maybe = looked.where("again").select(ROW, "id", "sha")
    groups = stage(maybe.groupBy("sha").agg(F.min(order).alias("first"), F.count("*").alias("n")))
    grouped = maybe.join(sized(groups, 120), "sha").select(
        ROW, "id", "sha", F.col("first.id").alias("keep_id"), "n", (F.col(f"first.{ROW}") == F.col(ROW)).alias("kept")
    )
    alone = looked.where("not again").select(
        ROW, "id", "sha", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("n"), F.lit(True).alias("kept")
    )
    return alone.unionByName(grouped)


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Texts do not move.

    ``docs`` is read twice (see ``placed``).
    """
    docs = placed(docs)
    dropped = stage(exact_groups(docs, id_col, text_col).where("not kept").select(ROW))
    return docs.join(sized(dropped, 16), ROW, "left_anti").drop(ROW)
