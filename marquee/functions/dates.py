"""Column functions for release dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.text import trim_ws

_WORD = r"[A-Za-z]{4,}"
_ABBR = r"[A-Za-z]{3}"

# Fixed values: (shape of the text, datetime pattern), in order of preference. The shape
# check keeps the date parser away from text it would have to reject, which
# costs an exception per row. Parts that are absent default to 1.
DATE_FORMATS: Sequence[tuple[str, str]] = (
    (rf"^{_WORD} \d{{1,2}}, \d{{4}}\z", "MMMM d, yyyy"),
    (rf"^{_ABBR} \d{{1,2}}, \d{{4}}\z", "MMM d, yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}\z", "M/d/yyyy"),
    (r"^\d{4}-\d{1,2}-\d{1,2}\z", "yyyy-M-d"),
    (r"^\d{1,2}-\d{1,2}-\d{4}\z", "d-M-yyyy"),
    (rf"^{_WORD} \d{{4}}\z", "MMMM yyyy"),
    (rf"^{_ABBR} \d{{4}}\z", "MMM yyyy"),
    (r"^\d{4}\z", "yyyy"),
    (rf"^\d{{1,2}} {_WORD} \d{{4}}\z", "d MMMM yyyy"),
    (rf"^\d{{1,2}} {_ABBR} \d{{4}}\z", "d MMM yyyy"),
    # Read in the usual order where possible, else in the other one.
    (r"^\d{1,2}/\d{1,2}/\d{4}\z", "d/M/yyyy"),
    (r"^\d{1,2}-\d{1,2}-\d{4}\z", "M-d-yyyy"),
    (r"^\d{4}/\d{1,2}/\d{1,2}\z", "yyyy/M/d"),
    (r"^\d{4}-\d{1,2}-\d{1,2} \d{2}:\d{2}:\d{2}\z", "yyyy-M-d HH:mm:ss"),
    (r"^\d{4}-\d{1,2}-\d{1,2}T\d{2}:\d{2}:\d{2}\z", "yyyy-M-d'T'HH:mm:ss"),
    (rf"^{_WORD} \d{{1,2}} \d{{4}}\z", "MMMM d yyyy"),
    (rf"^{_ABBR} \d{{1,2}} \d{{4}}\z", "MMM d yyyy"),
    (rf"^\d{{1,2}}-{_ABBR}-\d{{4}}\z", "d-MMM-yyyy"),
    (rf"^\d{{1,2}}-{_WORD}-\d{{4}}\z", "d-MMMM-yyyy"),
    (r"^\d{4}-\d{1,2}\z", "yyyy-M"),
    (r"^\d{8}\z", "yyyyMMdd"),
    (r"^\d{1,2}/\d{1,2}/\d{2}\z", "M/d/yy"),
    (r"^\d{4}\.\d{1,2}\.\d{1,2}\z", "yyyy.M.d"),
)

# What is written otherwise but means the same: an ordinal's ending, the dot of a
# short month, and "Sept".
_ORDINAL = r"(?i)\b(\d{1,2})(?:st|nd|rd|th)\b"
_DOTTED = r"(?i)\b([a-z]{3})(?:t\b)?\.? (?=\d)"


# A text is only tried with the patterns that share its first separator.
SEPARATORS = (" ", "/", "-", ".")


#: Years of two digits lie in the hundred years up to this one.
LAST_SHORT_YEAR = 2068


def date_of(text: Column, formats: Sequence[tuple[str, str]] = DATE_FORMATS, last_short: int = LAST_SHORT_YEAR) -> Column:
    """Trimmed date text to DATE by the first format that fits.

    Years of two digits lie in the hundred years up to ``last_short``, whenever it is read.
    """
    odd = text.rlike(r"(?i)[a-z]\. \d|\bsept \d|\d(?:st|nd|rd|th)\b")
    text = F.when(odd, F.regexp_replace(F.regexp_replace(text, _ORDINAL, "$1"), _DOTTED, "$1 ")).otherwise(text)
    tried: dict[str, list[Column]] = {sep: [] for sep in (*SEPARATORS, "")}
    for shape, pattern in formats:
        sep = next((s for s in SEPARATORS if s in pattern), "")
        date = F.try_to_date(text, pattern)
        if "yyyy" not in pattern:
            # Spark reads them as 2000 to 2099.
            date = F.add_months(date, 12 * (last_short // 100 * 100 - 2000))
            date = F.when(F.year(date) > last_short, F.add_months(date, -1200)).otherwise(date)
        tried[sep].append(F.when(text.rlike(shape), date))
    first = {sep: F.coalesce(*found, F.lit(None).cast("date")) for sep, found in tried.items()}
    date = F.when(text.contains(SEPARATORS[0]), first[SEPARATORS[0]])
    for sep in SEPARATORS[1:]:
        date = date.when(text.contains(sep), first[sep])
    return date.otherwise(first[""])


def parse_release_date(c: Column, formats: Sequence[tuple[str, str]] = DATE_FORMATS) -> Column:
    """Date text to DATE by the first format that fits; NULL if none does."""
    return date_of(trim_ws(c), formats)


def text_shape(text: Column, most: int = 80) -> Column:
    """The text with letters as ``a``, digits as ``9`` and runs of blanks as one space, cut to ``most`` characters."""
    shape = F.regexp_replace(F.regexp_replace(text, r"\p{L}", "a"), r"\p{Nd}", "9")
    return F.substring(F.regexp_replace(shape, r"[\s\x{A0}]+", " "), 1, most)


def unread_date(c: Column, formats: Sequence[tuple[str, str]] = DATE_FORMATS) -> Column:
    """Whether a text that is not blank is no date in any format."""
    text = trim_ws(c)
    return (text != "") & date_of(text, formats).isNull()


def year_of(text: Column, lenient: bool = False) -> Column:
    """Trimmed whole-number text to INT; ``lenient`` also takes ``1999.0``."""
    shape = r"^[+-]?\d+(\.0*)?\z" if lenient else r"^[+-]?\d+\z"
    return F.when(text.rlike(shape), F.substring_index(text, ".", 1).try_cast("int"))


def first_of_year(year: Column) -> Column:
    """1 January of a year number; NULL outside 1..9999."""
    return F.when(year.between(1, 9999), F.make_date(year, F.lit(1), F.lit(1)))


def date_or_year(date: Column, year: Column, lenient: bool = False) -> Column:
    """The date, or 1 January of the year text where the date is NULL.

    The year must be whole-number text; ``lenient`` also takes ``1999.0``.
    """
    return F.coalesce(date, first_of_year(year_of(trim_ws(year.cast("string")), lenient)))
