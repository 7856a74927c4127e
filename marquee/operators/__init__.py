"""DataFrame-to-DataFrame operators."""

from marquee.operators.aggregate import (
    count_distinct, distinct_values, extraction_counts, final_summary, group_sizes,
    missing_critical, missing_stats, null_counts, null_rows, observe_rows, value_counts,
)
from marquee.operators.columns import (
    absent_columns, lead_columns, narrow_ints, rename_columns, swap_where, unexpected_columns,
    union_relaxed,
)
from marquee.operators.dedup import (
    all_duplicates, duplicate_pieces, duplicate_report, duplicate_titles, keep_last, top_per_group,
)
from marquee.operators.html import Field, extract_items, extract_record
from marquee.operators.joins import lookup, merge_details, restrict_pages
from marquee.operators.profile import (
    analyze_column, describe_all, describe_numeric, describe_states, merge_states, profile, profile_states, unique_values,
)
from marquee.operators.quality import unread_dates, validate

__all__ = [name for name in dir() if not name.startswith("_")]
