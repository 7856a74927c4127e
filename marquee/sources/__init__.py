"""Readers for yearly CSV files and stored pages."""

from marquee.sources.csv import (
    CsvRead, UnreadableFiles, YearFiles, list_year_files, read_csv, read_csv_files, read_years, scan_csv_files, scan_years,
)
from marquee.sources.pages import read_pages, spread

__all__ = [
    "CsvRead", "UnreadableFiles", "YearFiles", "list_year_files", "read_csv", "read_csv_files", "read_pages",
    "read_years", "scan_csv_files", "scan_years", "spread",
]
