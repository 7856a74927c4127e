"""Column functions over text: trimming, null tokens, titles, links, money."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode White_Space characters.
UNICODE_WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Separators that Python's strip() removes as well.
INFORMATION_SEPARATORS = "\x1c\x1d\x1e\x1f"

# Texts that pandas reads as missing.
PANDAS_NA = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def trim_ws(c: Column, separators: bool = False) -> Column:
    """Strip all Unicode whitespace from both ends.

    Spark's plain ``trim`` removes spaces only. ``separators`` also strips
    U+001C to U+001F, as Python's ``str.strip`` does.
    """
    chars = UNICODE_WHITESPACE + (INFORMATION_SEPARATORS if separators else "")
    return F.btrim(c, F.lit(chars))


def is_null_token(c: Column) -> Column:
    """True for NULL, ``''``, ``'[]'`` and ``n/a`` in any case; never NULL."""
    return F.coalesce(F.lower(c).isin("", "[]", "n/a"), F.lit(True))


def token_to_null(text: Column) -> Column:
    """Null tokens to NULL, for text that is trimmed already."""
    return F.when(~F.lower(text).isin("", "[]", "n/a"), text)


def null_tokens(c: Column) -> Column:
    """Trim, then turn null tokens into NULL."""
    return token_to_null(trim_ws(c))


def null_if_in(c: Column, tokens: Iterable[str] = PANDAS_NA) -> Column:
    """NULL where the text is exactly one of ``tokens``."""
    return F.when(~c.isin(*tokens), c)


def norm_text(c: Column) -> Column:
    """Trimmed lower-case text; NULL stays NULL."""
    return F.lower(trim_ws(c, separators=True))


def unranked(c: Column) -> Column:
    """Text without a leading rank such as ``12. ``, trimmed.

    The rank is looked for before trimming, so a leading blank keeps it.
    """
    return trim_ws(F.regexp_replace(c, r"(?U)^\d+\.\s*", ""))


def clean_title(c: Column) -> Column:
    """Title without its rank, trimmed, null tokens to NULL."""
    return token_to_null(unranked(c))


def without_query(c: Column) -> Column:
    """URL up to its query string, trimmed.

    Only text with a line break needs the pattern, as a query does not
    reach over one.
    """
    cut = F.when(c.contains("\n"), F.regexp_replace(c, r"(?d)\?.*\z", ""))
    return trim_ws(cut.otherwise(F.substring_index(c, "?", 1)))


def clean_link(c: Column) -> Column:
    """URL without its query string, trimmed, null tokens to NULL."""
    return token_to_null(without_query(c))


def extract_id(c: Column) -> Column:
    """First ``tt`` + digits in a URL, NULL when there is none."""
    return F.nullif(F.regexp_extract(c, r"(?U)(tt\d+)", 1), F.lit(""))


def clean_money(c: Column) -> Column:
    """Narrow no-break spaces become thousands commas; no-break spaces go."""
    return F.translate(c, "\u202f\xa0", ",")


def money_amount(c: Column) -> Column:
    """Amount in money text as DECIMAL(20,2); NULL when no number is found."""
    digits = F.regexp_extract(F.translate(clean_money(c), ",", ""), r"\d+(?:\.\d+)?", 0)
    return F.when(digits != "", digits.try_cast("decimal(20,2)"))


def strip_parens(c: Column) -> Column:
    """Trim, remove no-break spaces, and cut the first and the last character."""
    text = F.translate(trim_ws(c, separators=True), "\xa0", "")
    return F.substring(text, F.lit(2), F.greatest(F.length(text) - 2, F.lit(0)))


def before(c: Column, mark: str = " (") -> Column:
    """Text before the first ``mark``, or all of it."""
    return F.substring_index(c, mark, 1)


def absolute_url(c: Column, base: str) -> Column:
    """``base`` + path; NULL stays NULL."""
    return F.concat(F.lit(base), c)
