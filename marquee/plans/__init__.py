"""Whole jobs put together from the operators."""

from marquee.plans.build import Built, build_catalogue, extract_details, extract_listing, write_built
from marquee.plans.catalogue import (
    CatalogueRun, Curated, check_columns, clean_catalogue, curate, run_catalogue, top_grossing,
)
from marquee.plans.normalise import normalise_catalogue, to_catalogue_v2

__all__ = [
    "Built", "CatalogueRun", "Curated", "build_catalogue", "check_columns", "clean_catalogue",
    "curate", "extract_details", "extract_listing", "normalise_catalogue", "run_catalogue",
    "to_catalogue_v2", "top_grossing", "write_built",
]
