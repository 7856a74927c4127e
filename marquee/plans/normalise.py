"""Normalise, encode and flag the catalogue for analysis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions import (
    duration_ok, missing_flag, norm_text, rating_code, rating_min_age, rating_min_age_int, to_number,
)
from marquee.functions.numbers import MISSING, hours_minutes, minutes_of, votes_of, whole
from marquee.functions.ratings import group_of, is_known_code
from marquee.operators.columns import narrow_ints, swap_where


def to_catalogue_v2(df: DataFrame) -> DataFrame:
    """Catalogue names to analysis names, with ``year`` taken from the date."""
    renames = {"mpa": "MPA", "méta_score": "meta_score"}
    return df.select(
        *(F.col(f"`{c}`").alias(renames.get(c, c)) for c in df.columns if c != "year"),
        F.year("release_date").alias("year"),
    )


def normalise_catalogue(df: DataFrame, strict: bool = True) -> DataFrame:
    """Analysis columns with fixed types, codes and missing flags.

    Adds ``duration_converted``, ``MPA_original``, ``MPA_min_age`` (text),
    ``MPA_min_age_int``, ``rating_as_category``, ``rating_was_missing`` and
    ``meta_score_was_missing``. Missing numbers become -1. The swap of
    misplaced ratings comes before both columns are read. ``strict`` fails
    on a year or score that is no number, otherwise it counts as missing.
    """
    def number(name: str) -> Column:
        c = F.col(name)
        return F.coalesce(c.cast("double") if strict else c.try_cast("double"), F.lit(float(MISSING)))

    def readable(name: str) -> Column:
        """The cell as text; numbers are cut to whole ones."""
        c = F.col(name)
        return whole(c).cast("string") if isinstance(df.schema[name].dataType, T.NumericType) else c.cast("string")

    def minutes() -> Column:
        read = minutes_of(F.col("_duration"), F.col("_parts"))
        if not isinstance(df.schema["duration"].dataType, T.NumericType):
            return read
        # A number counts as it is, a negative one too, which is no duration text.
        return F.coalesce(F.col("_duration").try_cast("bigint"), read)

    # One projection per level: what a level computes is used more than once
    # by the next, so Spark keeps them apart and computes it once per row.
    texts = df.withColumns({
        "id": norm_text(F.col("id")),
        "title": norm_text(F.col("title")),
        "votes": norm_text(readable("votes")),
        "_duration": norm_text(readable("duration")),
        "_mpa": norm_text(F.col("MPA")),
    })
    swap = is_known_code(F.col("_duration")) & F.col("MPA").isNull()
    swapped = swap_where(swap_where(texts.withColumn("_swap", swap), "duration", "MPA", F.col("_swap")),
                         "_duration", "_mpa", F.col("_swap"))
    parts = swapped.withColumn("_parts", hours_minutes(F.col("_duration")))
    parsed = parts.withColumns({
        "year": to_number(F.col("year"), strict),
        "duration": minutes(),
        "MPA_original": F.col("MPA"),
        "MPA": group_of(F.col("_mpa")),
        "rating": number("rating").cast("float"),
        "votes": votes_of(F.col("votes")),
        "meta_score": F.coalesce(number("meta_score").try_cast("bigint"), F.lit(MISSING)),
    }).drop("_duration", "_mpa", "_swap", "_parts")
    flagged = parsed.withColumns({
        "duration_converted": duration_ok(F.col("duration")),
        "MPA_min_age": rating_min_age(F.col("MPA")),
        "MPA_min_age_int": rating_min_age_int(F.col("MPA")),
        "rating_as_category": rating_code(F.col("rating")),
        "rating_was_missing": missing_flag(F.col("rating"), F.col("votes")),
        "meta_score_was_missing": missing_flag(F.col("meta_score")),
    })
    return narrow_ints(flagged, ["year", "duration", "votes", "meta_score"])
