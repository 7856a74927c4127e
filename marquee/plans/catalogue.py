"""From yearly files to the deduplicated catalogue."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions import extract_id, list_to_text, money_amount, trim_ws
from marquee.functions.dates import date_of, first_of_year, year_of
from marquee.functions.lists import list_or_null
from marquee.functions.numbers import clip, cut_to_int, decimal_or_null
from marquee.functions.text import token_to_null, unranked, without_query
from marquee.operators.aggregate import missing_stats, observe_rows
from marquee.operators.columns import (
    absent_columns, lead_columns, rename_columns, unexpected_columns,
)
from marquee.operators.dedup import duplicate_pieces, duplicate_report, keep_last, top_per_group
from marquee.operators.quality import LIST_COLUMNS, validate
from marquee.plans.schemas import BOOKKEEPING, CATALOGUE, RENAMES
from marquee.sinks import stage, write_duplicates, write_outputs
from marquee.sources import scan_years

log = logging.getLogger(__name__)

# Columns that are text as they stand.
PLAIN_TEXT = (
    "votes", "budget", "opening_weekend_gross", "gross_worldwide", "gross_us_canada", "mpa",
    "duration", "description",
)


class ColumnCheck(NamedTuple):
    """Columns the catalogue does not know, and catalogue columns that are absent."""

    unexpected: list[str]
    absent: list[str]


def check_columns(df: DataFrame) -> ColumnCheck:
    """Compare a raw frame with the catalogue, after renaming."""
    renamed = rename_columns(df, RENAMES)
    known = [*CATALOGUE.names, "year", *BOOKKEEPING]
    wanted = [c for c in CATALOGUE.names if c != "id"]
    return ColumnCheck(unexpected_columns(renamed, known), absent_columns(renamed, wanted))


def clean_catalogue(
    df: DataFrame, awards_as_text: bool = False, lenient_year: bool = False
) -> DataFrame:
    """Raw yearly rows to typed catalogue rows.

    Columns keep their order, ``id`` is added at the end and ``year`` is
    used for missing dates and dropped. Unknown columns are kept, absent
    ones are added as NULL. Awards are kept only when they are a printed
    list, unless ``awards_as_text``.

    Three projections: trim, read, combine. What one projection computes is
    used more than once by the next, so Spark keeps them apart and computes
    it once per row.
    """
    check = check_columns(df)
    if check.unexpected or check.absent:
        log.warning("unexpected columns %s, absent columns %s", *check)
    raw = rename_columns(df, RENAMES)
    types = {f.name: f.dataType for f in raw.schema.fields}
    present = [c for c in raw.columns if c not in ("year", "id")]
    order = [*present, *(c for c in CATALOGUE.names if c not in (*present, "id"))]

    def text(name: str) -> Column:
        c = F.col(f"`{name}`")
        return list_to_text(c) if isinstance(types[name], T.ArrayType) else c.cast("string")

    trim = {"title": unranked, "movie_link": without_query}
    trimmed = raw.select(*(
        (trim.get(c, trim_ws)(text(c)) if c in CATALOGUE.names or c == "year" else F.col(f"`{c}`")).alias(c)
        for c in (*present, *(["year"] if "year" in types else []))
    ))

    read: dict[str, Callable[[Column], Column]] = {c: list_or_null for c in LIST_COLUMNS}
    read |= {c: token_to_null for c in (*PLAIN_TEXT, "title", "movie_link")}
    if awards_as_text:
        read["awards_content"] = token_to_null
    read |= {
        "rating": decimal_or_null,
        "méta_score": cut_to_int,
        "release_date": date_of,
        "year": lambda c: year_of(c, lenient_year),
    }
    values = trimmed.select(*(
        read[c](F.col(f"`{c}`")).alias(c) if c in read else F.col(f"`{c}`") for c in trimmed.columns
    ))

    combined: dict[str, Column] = {
        f.name: F.lit(None).cast(f.dataType) for f in CATALOGUE.fields if f.name not in present
    }
    if "rating" in present:
        combined["rating"] = clip(F.col("rating"), 1.0, 10.0)
    if "méta_score" in present:
        combined["méta_score"] = clip(F.col("`méta_score`"), 0, 100)
    if "movie_link" in present:
        combined["id"] = extract_id(F.col("movie_link"))
    if "year" in types:
        date = F.col("release_date") if "release_date" in present else combined["release_date"]
        combined["release_date"] = F.coalesce(date, first_of_year(F.col("year")))
    return values.select(*(combined.get(c, F.col(f"`{c}`")).alias(c) for c in (*order, "id")))


class Curated(NamedTuple):
    """The catalogue, one row per id, with its reports."""

    catalogue: DataFrame
    violations: DataFrame
    duplicates: DataFrame
    missing: DataFrame


def curate(cleaned: DataFrame, order: Sequence[str] = BOOKKEEPING) -> Curated:
    """Validate, report duplicates, keep the last row per id, lead with id and title.

    Nothing runs yet. The cleaned rows are read by several results, so pass
    a stored table when they are costly to compute.
    """
    last = lead_columns(keep_last(cleaned, "id", order), ("id", "title"))
    catalogue = last.drop(*BOOKKEEPING)
    return Curated(catalogue, validate(cleaned), duplicate_report(cleaned), missing_stats(catalogue))


class CatalogueRun(NamedTuple):
    """What was written, the reports, the rows read and kept, and files that could not be read with the reason."""

    written: list[str]
    has_duplicates: bool
    reports: Curated
    rows_read: int
    rows_kept: int | None
    skipped: dict[str, str]


def run_catalogue(
    spark: SparkSession, root: str, out: str, formats: Sequence[str] = ("csv", "parquet", "arrow"),
    multi_line: bool = True,
) -> CatalogueRun:
    """Yearly files below ``root`` to the catalogue files below ``out``.

    Files are parsed and cleaned once, into a stored table that feeds the
    reports and the catalogue. An id with very many titles takes several rows
    of the duplicate report (see ``duplicate_pieces``). Files without quoted line breaks are split over
    tasks if ``multi_line`` is off.
    """
    found_files = scan_years(spark, root, multi_line=multi_line)
    raw, read = observe_rows(clean_catalogue(found_files.rows), "read")
    cleaned = stage(raw)
    result = curate(cleaned)._replace(duplicates=duplicate_pieces(cleaned).drop("piece"))
    found = write_duplicates(result.duplicates, f"{out.rstrip('/')}/duplicates.csv")
    kept, count = observe_rows(result.catalogue, "kept")
    written = write_outputs(kept, out, formats)
    rows_kept = count.get["rows"] if written else None
    return CatalogueRun(written, found, result, read.get["rows"], rows_kept, found_files.skipped)


def top_grossing(df: DataFrame, group: str = "src_year", gross: str = "gross_us_canada", n: int = 600) -> DataFrame:
    """The ``n`` films per year with the highest domestic gross; ties by id."""
    amount = df.withColumn("_amount", money_amount(F.col(f"`{gross}`")))
    return top_per_group(amount, group, [F.desc_nulls_last("_amount"), F.col("id")], n).drop("_amount")
