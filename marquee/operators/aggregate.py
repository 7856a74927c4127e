"""Counts and summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of the missing-value report, and those that must not be missing.
REPORTED = ("id", "title", "rating", "méta_score", "release_date")
CRITICAL = ("id", "title")


def missing_stats(df: DataFrame, cols: Sequence[str] = REPORTED) -> DataFrame:
    """One row: share of NULLs per column, in percent."""
    return df.agg(*(
        (F.avg(F.col(f"`{c}`").isNull().cast("double")) * 100).alias(f"missing_{c}") for c in cols
    ))


def missing_critical(stats: DataFrame, cols: Sequence[str] = CRITICAL) -> DataFrame:
    """Long form of the critical columns that have any NULL: column, percent."""
    present = [c for c in cols if f"missing_{c}" in stats.columns]
    long = stats.select(*(F.col(f"`missing_{c}`").alias(c) for c in present)).unpivot(
        [], list(present), "column", "percent"
    )
    return long.filter("percent > 0")


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Number of NULLs, one row per column; a single pass over the data."""
    cols = list(cols or df.columns)
    wide = df.agg(*(F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols))
    return wide.unpivot([], [F.col(f"`{c}`") for c in cols], "column", "nulls")


def null_rows(df: DataFrame, c: str) -> DataFrame:
    """Rows where the column is NULL."""
    return df.filter(F.col(f"`{c}`").isNull())


def value_counts(df: DataFrame, c: str, top: int | None = None, min_count: int = 1) -> DataFrame:
    """Occurrences of each present value, most frequent first; ties by value."""
    counts = df.filter(F.col(f"`{c}`").isNotNull()).groupBy(f"`{c}`").count()
    if min_count > 1:
        counts = counts.filter(F.col("count") >= min_count)
    ordered = counts.orderBy(F.desc("count"), F.col(f"`{c}`"))
    return ordered if top is None else ordered.limit(top)


def group_sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per combination of keys, NULL keys kept, sorted with NULLs last."""
    sizes = df.groupBy(*(F.col(f"`{k}`") for k in keys)).count()
    return sizes.orderBy(*(F.col(f"`{k}`").asc_nulls_last() for k in keys))


def distinct_values(df: DataFrame, c: str, flatten: bool = False) -> DataFrame:
    """Distinct values of a column, NULL included.

    ``flatten`` takes the items of an array column instead, without NULLs.
    """
    if flatten:
        items = df.select(F.explode(F.col(f"`{c}`")).alias(c))
        return items.filter(F.col(f"`{c}`").isNotNull()).distinct()
    return df.select(f"`{c}`").distinct()


def count_distinct(df: DataFrame, c: str, exact: bool = True) -> Column:
    """Aggregate for the number of distinct present values."""
    col = F.col(f"`{c}`")
    return F.count_distinct(col) if exact else F.approx_count_distinct(col)


def final_summary(df: DataFrame) -> DataFrame:
    """One row about duration and age rating of a normalised catalogue.

    Rows are first combined per rating and minimum age, so the distinct
    counts run over a handful of groups instead of expanding every row.
    """
    groups = df.groupBy("MPA", "MPA_min_age").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("duration").alias("lo"),
        F.max("duration").alias("hi"),
        F.count_if("duration_converted").alias("ok"),
    )
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("MPA").isNull(), F.col("n"))), F.lit(0)).alias("mpa_nulls"),
        F.min("lo").alias("duration_min"),
        F.max("hi").alias("duration_max"),
        F.coalesce(F.sum("ok"), F.lit(0)).alias("converted"),
        F.coalesce(F.sum(F.col("n") - F.col("ok")), F.lit(0)).alias("not_converted"),
        F.try_divide(F.sum("ok") * F.lit(100.0), F.sum("n")).alias("success_rate"),
        F.count_distinct("MPA").alias("mpa_groups"),
        F.count_distinct("MPA_min_age").alias("min_ages"),
    )


def extraction_counts(df: DataFrame, by: str = "src_year") -> DataFrame:
    """Extracted rows and field or row errors per year."""
    failed = F.col("_failed") if "_failed" in df.columns else F.lit(False)
    return df.groupBy(by).agg(
        F.count_if(~failed).alias("rows"),
        F.sum(F.size("_errors")).cast("bigint").alias("errors"),
    )


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows as they pass, in whatever job runs first; no job of its own.

    ``observation.get["rows"]`` holds the count once that job is done.
    """
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)
