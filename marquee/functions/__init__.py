"""Column-to-column functions; all of them are built-in Spark expressions."""

from marquee.functions.dates import DATE_FORMATS, date_or_year, parse_release_date, text_shape, unread_date
from marquee.functions.lists import (
    is_list_text, list_text_or_null, list_to_text, malformed_list, text_to_list,
)
from marquee.functions.numbers import (
    duration_minutes, duration_ok, is_duration, missing_flag, out_of_range, parse_rating,
    parse_score, parse_votes, rating_code, to_number,
)
from marquee.functions.ratings import (
    map_values, misplaced_rating, rating_group, rating_min_age, rating_min_age_int,
)
from marquee.functions.text import (
    PANDAS_NA, absolute_url, before, clean_link, clean_money, clean_title, extract_id,
    is_null_token, money_amount, norm_text, null_if_in, null_tokens, strip_parens, trim_ws,
)

__all__ = [name for name in dir() if not name.startswith("_")]
