"""Writers for catalogues and reports."""

from marquee.sinks.files import (
    as_csv_text, write_arrow, write_csv, write_duplicates, write_outputs, write_parquet, write_yearly,
)
from marquee.sinks.staging import drop_staged, shared_folder, stage

__all__ = [
    "as_csv_text", "drop_staged", "shared_folder", "stage", "write_arrow", "write_csv", "write_duplicates",
    "write_outputs", "write_parquet", "write_yearly",
]
