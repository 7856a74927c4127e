"""Column functions that turn text into numbers, codes and flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.text import norm_text, trim_ws

# Plain decimal or exponent notation. Spark's own cast would also take
# '1.0d', '7f', 'NaN' and 'Infinity'.
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\z"
INTEGER = r"^[+-]?\d+\z"

# Fixed values. Full-match duration shapes on trimmed lower-case text:
# "1h 30m"/"30m", "90 min"/"45 minutes", "2 hours"/"2h", "1:15", "90".
DURATION = (
    r"(?U)^(?:(?:(\d+)\s*h)?\s*(\d+)\s*m"
    r"|(\d+)\s*min(?:utes?)?"
    r"|(\d+)\s*h(?:ours?)?"
    r"|(\d+):(\d+)"
    r"|(\d+))\z"
)
# Hours and minutes out of whichever shape matched; no duration starts with '='.
HOURS_MINUTES = "=$1$4$5:$2$3$6$7"

MISSING = -1


def clip(v: Column, lo: float, hi: float) -> Column:
    """Limit to ``lo..hi``; NULL stays NULL, which greatest and least ignore."""
    return F.when(v < lo, lo).when(v > hi, hi).otherwise(v)


def decimal_or_null(text: Column) -> Column:
    """Trimmed number text to DOUBLE, NULL if it is no plain number.

    The pattern also spares the cast, which is slow on text it rejects.
    """
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def cut_to_int(text: Column) -> Column:
    """Trimmed number text to INT; decimals are cut, not rounded."""
    return F.when(text.rlike(r"^[+-]?\d+(\.[0-9]*)?\z"), F.substring_index(text, ".", 1).try_cast("int"))


def parse_rating(c: Column) -> Column:
    """Rating text to DOUBLE clipped to 1..10; anything unreadable is NULL."""
    return clip(decimal_or_null(trim_ws(c.cast("string"))), 1.0, 10.0)


def parse_score(c: Column) -> Column:
    """Score text to INT clipped to 0..100; decimals are cut, not rounded."""
    return clip(cut_to_int(trim_ws(c.cast("string"))), 0, 100)


def is_decimal_type(c: Column) -> Column:
    """Whether the column is of a fractional type; constant, so Spark plans one branch only."""
    return F.typeof(c).isin("float", "double") | F.typeof(c).startswith("decimal")


def is_number_type(c: Column) -> Column:
    return is_decimal_type(c) | F.typeof(c).isin("tinyint", "smallint", "int", "bigint")


def whole(c: Column) -> Column:
    """A number column to BIGINT; fractions are cut. NULL for NaN and what does not fit."""
    return c.try_cast("bigint")


def to_number(c: Column, strict: bool = True) -> Column:
    """Number text such as ``1999`` or ``1999.0`` to INT.

    ``strict`` fails the job on other text and on fractions, else they give
    NULL.
    """
    text = trim_ws(c.cast("string"))
    value = decimal_or_null(text)
    number = F.when(value == F.floor(value), value.try_cast("int"))
    if not strict:
        return number
    message = F.concat(F.lit("no whole number: "), text)
    return F.when(c.isNotNull() & number.isNull(), F.raise_error(message).cast("int")).otherwise(number)


def is_duration(c: Column) -> Column:
    """Whether the text is a known duration shape; NULL counts as valid."""
    return F.coalesce(norm_text(c.cast("string")).rlike(DURATION), F.lit(True))


def hours_minutes(text: Column) -> Column:
    """Trimmed lower-case duration as ``=H:M`` with empty parts allowed.

    Text of no known shape comes back as it is.
    """
    return F.regexp_replace(text, DURATION, HOURS_MINUTES)


def minutes_of(text: Column, parts: Column) -> Column:
    """Minutes as BIGINT from a duration and its ``=H:M`` form; -1 if unknown."""
    hours = F.substring_index(F.substring(parts, 2, 2**31 - 1), ":", 1)
    minutes = F.substring_index(parts, ":", -1)
    total = F.try_add(
        F.try_multiply(F.when(hours == "", "0").otherwise(hours).try_cast("bigint"), F.lit(60)),
        F.when(minutes == "", "0").otherwise(minutes).try_cast("bigint"),
    )
    return F.coalesce(F.when(text != parts, total), F.lit(MISSING).cast("bigint"))


def duration_minutes(c: Column) -> Column:
    """Duration to whole minutes as BIGINT; -1 if missing or unknown.

    Numbers are cut, text is read by its shape.
    """
    text = norm_text(c.cast("string"))
    return F.when(is_number_type(c), F.coalesce(whole(c), F.lit(MISSING))).otherwise(
        minutes_of(text, hours_minutes(text))
    )


def duration_ok(minutes: Column) -> Column:
    """Whether a parsed duration is a real one."""
    return minutes != MISSING


def votes_of(text: Column) -> Column:
    """Trimmed lower-case vote text such as ``1.2k`` to BIGINT; -1 if unknown.

    The product is taken in DOUBLE and then cut, so ``8.2m`` is 8199999.
    """
    number = trim_ws(F.substring(text, F.lit(1), F.length(text) - 1), separators=True)
    factor = F.when(text.endswith("k"), 1_000).when(text.endswith("m"), 1_000_000)
    votes = F.when(factor.isNotNull(), (decimal_or_null(number) * factor).try_cast("bigint")).when(
        text.rlike(INTEGER), text.try_cast("bigint")
    )
    return F.coalesce(votes, F.lit(MISSING).cast("bigint"))


def parse_votes(c: Column) -> Column:
    """Votes, as numbers or as text such as ``1.2K`` or ``3M``, to BIGINT; -1 if missing or unknown."""
    return F.when(is_number_type(c), F.coalesce(whole(c), F.lit(MISSING))).otherwise(votes_of(norm_text(c.cast("string"))))


def rating_code(c: Column) -> Column:
    """Position of a FLOAT rating on the grid -1, 0.0, 0.1 ... 10.0.

    -1 is 0, 0.0 is 1 and 10.0 is 101; values off the grid are NULL.
    """
    r = c.cast("float")
    on_grid = r.between(0, 10) & (F.round(r, 1) == r)
    return F.when(r == MISSING, 0).when(on_grid, (F.round(r * 10) + 1).cast("int"))


def missing_flag(*cols: Column) -> Column:
    """True when any of the columns holds the missing marker -1."""
    flag = cols[0] == MISSING
    for c in cols[1:]:
        flag = flag | (c == MISSING)
    return flag


def out_of_range(c: Column, lo: float, hi: float) -> Column:
    """A value that is present but outside ``lo..hi``; NULL is exempt."""
    return c.isNotNull() & ~c.between(lo, hi)
