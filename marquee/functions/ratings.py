"""Age ratings: code to group, group to minimum age."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.text import norm_text

# Age-rating codes of each group.
RATING_GROUPS = {
    "general": ("g", "tv-g", "tv-y"),
    "parental_guidance": (
        "pg", "tv-pg", "approved", "passed", "m", "m/pg", "gp", "tv-y7", "tv-y7-fv",
    ),
    "teen": ("pg-13", "tv-14", "tv-13", "13+"),
    "mature": ("r", "tv-ma", "ma-17", "16+"),
    "adults_only": ("nc-17", "x", "18+"),
    "unrated": ("not rated", "unrated", "none", "e"),
}
# Minimum age of each group; 'unrated' has none.
MIN_AGE = {"general": 0, "parental_guidance": 7, "teen": 13, "mature": 17, "adults_only": 18}

UNRATED = "unrated"
KNOWN_CODES = tuple(code for codes in RATING_GROUPS.values() for code in codes)


def map_values(c: Column, mapping: Mapping, default) -> Column:
    """Constant lookup with a default for absent keys and for NULL.

    Keys with the same value share one IN test, so the lookup stays a
    CASE expression inside code generation.
    """
    keys_of = defaultdict(list)
    for key, value in mapping.items():
        keys_of[value].append(key)
    result = None
    for value, keys in keys_of.items():
        result = (result.when if result is not None else F.when)(c.isin(*keys), F.lit(value))
    return result.otherwise(default) if result is not None else F.lit(default)


def group_of(text: Column) -> Column:
    """Trimmed lower-case rating code to its group."""
    group = F.when(F.lit(False), F.lit(UNRATED))
    for name, codes in RATING_GROUPS.items():
        group = group.when(text.isin(*codes), F.lit(name))
    return group.otherwise(UNRATED)


def rating_group(c: Column) -> Column:
    """Age-rating code to its group; unknown and NULL are ``unrated``."""
    return group_of(norm_text(c))


def rating_min_age(group: Column) -> Column:
    """Minimum age of a group as text, or ``unrated``."""
    return map_values(group, {g: str(age) for g, age in MIN_AGE.items()}, UNRATED)


def rating_min_age_int(group: Column) -> Column:
    """Minimum age of a group as INT, NULL for ``unrated``."""
    return map_values(group, MIN_AGE, F.lit(None).cast("int"))


def is_known_code(text: Column) -> Column:
    """Whether trimmed lower-case text is a rating code; NULL is not."""
    return F.coalesce(text.isin(*KNOWN_CODES), F.lit(False))


def misplaced_rating(duration: Column, mpa: Column) -> Column:
    """The duration holds a known rating code while the rating is missing."""
    return is_known_code(norm_text(duration)) & mpa.isNull()
