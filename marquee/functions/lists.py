"""Column functions for lists that are stored as text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.text import UNICODE_WHITESPACE, trim_ws


def is_list_text(c: Column) -> Column:
    """Whether the text is one bracketed line, ``[...]``."""
    return c.startswith("[") & c.endswith("]") & ~c.contains("\n")


def list_or_null(text: Column) -> Column:
    """Trimmed text if it is a list that is not empty, else NULL."""
    return F.when(is_list_text(text) & (text != "[]"), text)


def list_text_or_null(c: Column) -> Column:
    """Trimmed list text; NULL for null tokens, ``[]`` and anything else."""
    return list_or_null(trim_ws(c))


def malformed_list(c: Column) -> Column:
    """Text that is present but is not a bracketed list."""
    return c.isNotNull() & ~is_list_text(c)


def _escape(item: Column) -> Column:
    codes = {"\\": "\\\\", "\t": "\\t", "\n": "\\n", "\r": "\\r"}
    for ch in UNICODE_WHITESPACE.replace(" ", ""):
        codes.setdefault(ch, f"\\x{ord(ch):02x}" if ord(ch) < 256 else f"\\u{ord(ch):04x}")
    escaped = reduce(lambda s, kv: F.replace(s, F.lit(kv[0]), F.lit(kv[1])), codes.items(), item)
    return F.when(item.rlike(r"[\\\p{Cntrl}\p{Z}&&[^ ]]"), escaped).otherwise(item)


def _quote(item: Column) -> Column:
    text = _escape(item)
    double = F.concat(F.lit('"'), text, F.lit('"'))
    single = F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("\\'")), F.lit("'"))
    quoted = F.when(item.contains("'") & ~item.contains('"'), double).otherwise(single)
    return F.coalesce(quoted, F.lit("None"))


def list_to_text(c: Column) -> Column:
    """Array of text to the way Python prints a list of strings."""
    return F.concat(F.lit("["), F.array_join(F.transform(c, _quote), ", "), F.lit("]"))


def text_to_list(c: Column) -> Column:
    """Printed list back to an array of text; NULL if it is not one."""
    as_json = F.regexp_replace(c, r"(?<!\\)((?:\\\\)*)\\x([0-9a-fA-F]{2})", r"$1\\u00$2")
    return F.from_json(as_json, "array<string>")
