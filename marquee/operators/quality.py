"""Validation of a raw or a cleaned catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import malformed_list, out_of_range, text_shape, trim_ws, unread_date
from marquee.operators.dedup import top_per_group

# Columns of printed lists, and ranges of numbers.
LIST_COLUMNS = (
    "writers", "directors", "stars", "countries_origin", "filming_locations",
    "production_companies", "awards_content", "genres", "languages",
)
RANGES = {"rating": (1.0, 10.0), "méta_score": (0, 100)}


def unread_dates(df: DataFrame, c: str = "release_date") -> DataFrame:
    """Shapes of the texts in ``c`` that no date format reads: shape, rows, distinct texts, and the smallest text.

    Rows are counted per text first, so a text is tried once per task however
    often it occurs. What is read is left out of the sums and not by a filter,
    which Spark would push down, where it evaluates every format's copy of the
    text anew.
    """
    texts = df.groupBy(F.col(f"`{c}`").alias("text")).agg(F.count(F.lit(1)).alias("n"))
    tried = texts.select("text", "n", text_shape(trim_ws(F.col("text"))).alias("shape"), unread_date(F.col("text")).alias("unread"))
    return tried.groupBy("shape").agg(
        F.sum(F.when(F.col("unread"), F.col("n"))).alias("rows"), F.count_if("unread").alias("texts"),
        F.min(F.when(F.col("unread"), F.col("text"))).alias("sample"),
    ).filter("texts > 0")


def checks(df: DataFrame) -> dict[tuple[str, str], Column]:
    """(check, column) to the condition that marks a bad row."""
    found = {("list_format", c): malformed_list(F.col(c)) for c in LIST_COLUMNS if c in df.columns}
    for c, (lo, hi) in RANGES.items():
        if c in df.columns:
            # Raw text that is no number is not a range violation.
            found["range", c] = F.coalesce(out_of_range(F.col(f"`{c}`").try_cast("double"), lo, hi), F.lit(False))
    return found


def validate(df: DataFrame, samples: int = 5) -> DataFrame:
    """One row per check: check, column, n_bad, and the smallest bad values.

    Counts come from one aggregation. Bad cells alone are ranked for the
    samples, so nothing larger than the samples is gathered.
    """
    found = checks(df)
    names = [f"{i}" for i in range(len(found))]
    counts = df.agg(*(F.count_if(cond).alias(name) for name, cond in zip(names, found.values())))
    counts = counts.unpivot([], names, "_check", "n_bad")

    bad = F.array_compact(F.array(*(
        F.when(cond, F.struct(F.lit(name).alias("_check"), F.col(f"`{c}`").cast("string").alias("value")))
        for name, ((_, c), cond) in zip(names, found.items())
    )))
    cells = df.select(F.explode(bad).alias("b")).select("b.*").groupBy("_check", "value").count()
    first = (
        top_per_group(cells, "_check", [F.col("value")], samples)
        .groupBy("_check")
        .agg(F.sort_array(F.collect_list("value")).alias("sample"))
    )
    label = F.array(*(
        F.struct(F.lit(check).alias("check"), F.lit(c).alias("column")) for check, c in found
    ))[F.col("_check").cast("int")]
    return (
        counts.join(F.broadcast(first), "_check", "left")
        .select(label.alias("_l"), "n_bad", F.coalesce("sample", F.array().cast("array<string>")).alias("sample"))
        .select("_l.check", "_l.column", "n_bad", "sample")
    )
