"""From stored pages to the listing, details and merged tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import absolute_url, before, clean_money, strip_parens, trim_ws
from marquee.operators.aggregate import observe_rows
from marquee.operators.html import extract_items, extract_record
from marquee.operators.joins import merge_details, restrict_pages
from marquee.plans.schemas import (
    DETAIL_FIELDS, LIST_CONTAINER, LIST_ITEM, LISTING_FIELDS, MONEY,
)
from marquee.sinks import stage, write_csv


def _ids(pages: DataFrame, *names: str) -> list[str]:
    return [c for c in ("src_year", *names) if c in pages.columns]


def extract_listing(pages: DataFrame, base_url: str, on_error: str = "drop") -> DataFrame:
    """One row per film on the list pages: the nine listing columns."""
    items = extract_items(
        pages, LIST_ITEM, LISTING_FIELDS, LIST_CONTAINER, _ids(pages, "page_id"), on_error=on_error
    )
    return items.withColumns({
        "Votes": strip_parens(F.col("Votes")),
        "description": trim_ws(F.col("description"), separators=True),
        "Movie Link": absolute_url(F.col("`Movie Link`"), base_url),
    })


def extract_details(pages: DataFrame, on_error: str = "drop") -> DataFrame:
    """One row per title page: ``link`` and the fourteen detail columns."""
    rows = extract_record(pages, DETAIL_FIELDS, _ids(pages, "url"), on_error=on_error)
    return rows.withColumns({
        **{c: clean_money(F.col(c)) for c in MONEY},
        "release_date": before(F.col("release_date"), " ("),
    }).withColumnRenamed("url", "link")


class Built(NamedTuple):
    """The tables, and the films and title pages that were left out, each with its ``_errors``."""

    listing: DataFrame
    details: DataFrame
    merged: DataFrame
    failed_films: DataFrame
    failed_pages: DataFrame


def _split(rows: DataFrame, *ids: str) -> tuple[DataFrame, DataFrame]:
    """Rows that could be read, and ids and errors of those that could not."""
    kept = [c for c in ("src_year", *ids, "_errors") if c in rows.columns]
    return rows.filter(~F.col("_failed")).drop("_failed"), rows.filter("_failed").select(*kept)


def build_catalogue(
    list_pages: DataFrame, title_pages: DataFrame, base_url: str, store: bool = True
) -> Built:
    """All years in one job: list pages and title pages to the merged table.

    Title pages that no listing links to are left out before they are
    parsed. The listing is used more than once, so it is stored first, unless
    ``store`` is False.
    """
    films = extract_listing(list_pages, base_url, on_error="keep")
    listing, failed_films = _split(stage(films) if store else films, "page_id")
    pages = extract_details(restrict_pages(title_pages, listing), on_error="keep")
    details, failed_pages = _split(pages, "link")
    per_year = "src_year" in listing.columns and "src_year" in details.columns
    merged = merge_details(
        listing.drop("_errors", "_item", "page_id"), details.drop("_errors"), per_year=per_year
    )
    return Built(listing, details, merged, failed_films, failed_pages)


def write_built(built: Built, out: str) -> dict[str, int]:
    """Listing, details and merged rows as CSV, one folder per year each.

    Returns the rows written to ``basic``, ``advanced`` and ``merged``.
    """
    details = stage(built.details).drop("_errors")  # parsed once for both tables
    listing = built.listing.drop("_errors", "_item", "page_id")
    per_year = "src_year" in details.columns
    tables = {
        "basic": listing,
        "advanced": details,
        "merged": merge_details(listing, details, per_year=per_year),
    }
    rows = {}
    for name, df in tables.items():
        counted, observation = observe_rows(df, name)
        folders = ("src_year",) if "src_year" in df.columns else ()
        write_csv(counted, f"{out.rstrip('/')}/{name}", folders)
        rows[name] = observation.get["rows"]
    return rows
