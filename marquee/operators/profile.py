"""Column profiles: full describe, exact quantiles, per-column reports."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.operators.aggregate import (
    distinct_values, is_numeric, null_counts, null_rows, value_counts,
)
from marquee.operators.dedup import all_duplicates

QUARTILES = (0.25, 0.5, 0.75)
# Rank error of the approximate quantiles is at most rows / ACCURACY.
ACCURACY = 10_000
# Size of the sketches of ranks. Their rank error is stated as 2.296 / SKETCH ** 0.9021
# in 99 of 100 cases; a bracket reaches four times as far on either side.
SKETCH = 4096
MARGIN = 4 * 2.296 / SKETCH**0.9021
# Each bracket of a quantile is counted in so many equal stretches; only values
# of the stretches that hold a wanted rank are ranked.
STRETCHES = 1_000


def _long(df: DataFrame, cols: Sequence[str], dtype: str) -> DataFrame:
    """One (column, value) row per cell of the given columns."""
    cells = df.select(*(F.col(f"`{c}`").cast(dtype).alias(c) for c in cols))
    return cells.unpivot([], [F.col(f"`{c}`") for c in cols], "column", "value")


def _brackets(probs: Sequence[float], accuracy: int) -> Column:
    """Approximate quantiles a little below and a little above each wanted one."""
    margin = 2 / accuracy
    ends = [max(0.0, p - margin) for p in probs] + [min(1.0, p + margin) for p in probs]
    return F.approx_percentile("value", ends, accuracy)


def numeric_stats(
    long: DataFrame, probs: Sequence[float] = QUARTILES, accuracy: int = ACCURACY, exact: bool = True
) -> DataFrame:
    """Count, mean, sample deviation, extremes and quantiles of (column, value).

    Quantiles are exact with linear interpolation, yet no task holds a whole
    column: approximate quantiles with a known rank error bracket each wanted
    rank. A bracket, about 4/accuracy of the rows, is counted in stretches, and
    only values of the stretch that holds the rank are ranked one by one. It is
    an error if a rank lay outside its bracket.
    The brackets, one row per column, are computed first, by a job of their
    own: read lazily they would be computed anew for every use.
    """
    stats = long.groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        (_brackets(probs, accuracy) if exact else F.approx_percentile("value", list(probs), accuracy))
        .alias("_ends"),
    )
    n = len(probs)
    names = [_name(p) for p in probs]
    if not exact:
        found = (F.col("_ends")[i].alias(name) for i, name in enumerate(names))
        return stats.select("column", "count", "mean", "std", "min", *found, "max")

    known = stats.collect()
    session, shape = long.sparkSession, stats.schema
    stats = session.createDataFrame(known, shape)
    few = F.col("count") <= accuracy  # too few rows for the rank error to mean much
    ends = stats.select(
        "column",
        *(F.when(few, F.col("min")).otherwise(F.col("_ends")[i]).alias(f"lo{i}") for i in range(n)),
        *(F.when(few, F.col("max")).otherwise(F.col("_ends")[n + i]).alias(f"hi{i}") for i in range(n)),
    )
    value = F.col("value")
    inside, passed = F.lit(False), F.lit(0)
    for i in range(n):
        inside = inside | value.between(F.col(f"lo{i}"), F.col(f"hi{i}"))
        passed = passed + (value > F.col(f"hi{i}")).cast("int")
    counted = (
        long.filter(value.isNotNull())
        .join(F.broadcast(ends), "column")  # one row per column
        .groupBy("column", passed.alias("passed"), F.when(inside, value).alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return _with_quantiles(stats, counted, ends, probs)


def _with_quantiles(stats: DataFrame, counted: DataFrame, ends: DataFrame, probs: Sequence[float]) -> DataFrame:
    """``stats`` with exact quantiles, from counts of the values inside brackets and of all values between them.

    ``counted`` has column, passed (brackets that lie below), v (null between
    brackets) and n; ``ends`` has the brackets of each column.
    """
    from marquee.sinks.staging import stage

    n, names = len(probs), [_name(p) for p in probs]
    # Values inside brackets with their stretch; what lies between two brackets
    # comes before the next one's values, as stretch -1.
    low, high = (F.element_at(F.array(*(F.col(f"{end}{i}") for i in range(n))), F.col("passed") + 1) for end in ("lo", "hi"))
    stretch = F.when(F.col("v").isNull(), -1).when(high > low, F.floor((F.col("v") - low) / (high - low) * STRETCHES)).otherwise(0)
    counted = stage(
        counted.join(F.broadcast(ends), "column").select("column", "passed", "v", "n", stretch.cast("int").alias("stretch"))
    )
    upto = Window.partitionBy("column").orderBy("passed", "stretch").rowsBetween(Window.unboundedPreceding, 0)
    exact_ranks = [(F.col("count") - 1) * F.lit(float(p)) for p in probs]
    ranks = [whole(r) for r in exact_ranks for whole in (F.floor, F.ceil)]
    wanted = F.lit(False)
    for rank in ranks:
        wanted = wanted | ((F.col("before") <= rank) & (rank < F.col("before") + F.col("n")))
    # At most quantiles * (stretches + 1) rows per column.
    chosen = (
        counted.groupBy("column", "passed", "stretch").agg(F.sum("n").alias("n"))
        .withColumn("before", F.sum("n").over(upto) - F.col("n"))
        .join(F.broadcast(stats.select("column", "count")), "column")
        .filter(wanted)
        .withColumn("before", F.when(F.col("stretch") >= 0, F.col("before")).otherwise(
            F.raise_error(F.lit("a quantile lies outside its bracket")).cast("long")))
        .select("column", "passed", "stretch", "before", "count")
    )
    running = Window.partitionBy("column", "passed", "stretch").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.join(F.broadcast(chosen), ["column", "passed", "stretch"]).withColumn(
        "upto", F.col("before") + F.sum("n").over(running)
    )

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("upto") > rank, F.col("v")))

    def quantile(p: float) -> Column:
        rank = (F.col("count") - 1) * F.lit(float(p))
        low, high, part = at(F.floor(rank)), at(F.ceil(rank)), F.max(rank - F.floor(rank))
        return low + (high - low) * part

    quantiles = ranked.groupBy("column").agg(*(quantile(p).alias(name) for p, name in zip(probs, names)))
    return stats.join(F.broadcast(quantiles), "column", "left").select(
        "column", "count", "mean", "std", "min", *names, "max"
    )


def _name(p: float) -> str:
    return f"p{round(p * 100):02d}"


def _numbers(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    """The columns as doubles; NaN counts as missing."""
    cells = (F.col(f"`{c}`").cast("double") for c in cols)
    return [F.when(~F.isnan(cell), cell) for cell in cells]


def profile_states(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), distinct: bool = True) -> DataFrame:
    """One row per group of ``by`` and numeric column, which ``merge_states`` can add to those of other rows.

    Count, missing, mean, summed squared deviations, extremes, and sketches of
    ranks (KLL) and of distinct values (HLL). One aggregate reads all columns
    side by side. Kept in a file per year, say, the states of any years give
    their common profile without reading the rows again.
    """
    cells = _numbers(df, cols)
    groups = [F.col(f"`{c}`") for c in by]
    wide = df.select(*groups, *(cell.alias(f"c{i}") for i, cell in enumerate(cells))).groupBy(*groups).agg(*(
        F.struct(
            F.lit(c).alias("column"),
            F.count(f"c{i}").alias("count"),
            F.count_if(F.col(f"c{i}").isNull()).alias("nulls"),
            F.avg(f"c{i}").alias("mean"),
            (F.var_pop(f"c{i}") * F.count(f"c{i}")).alias("m2"),
            F.min(f"c{i}").alias("min"),
            F.max(f"c{i}").alias("max"),
            F.kll_sketch_agg_double(f"c{i}", F.lit(SKETCH)).alias("ranks"),
            (F.hll_sketch_agg(F.col(f"c{i}").cast("string")) if distinct else F.lit(None).cast("binary")).alias("values"),
        ).alias(f"s{i}")
        for i, c in enumerate(cols)
    ))
    return wide.select(*groups, F.inline(F.array(*(f"s{i}" for i in range(len(cols))))))


def merge_states(states: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """States of larger groups: of all rows, or of each group of ``by``, which ``states`` must have."""
    keys = [*by, "column"]
    total = F.sum("count")
    mean = (F.sum(F.col("mean") * F.col("count")) / F.nullif(total, F.lit(0))).alias("_mean")
    apart = F.col("mean") - F.col("_mean")
    # Deviations from the common mean, so that nothing large cancels out.
    centred = states.groupBy(*keys).agg(mean)
    alike = F.lit(True)
    for k in keys:
        alike = alike & F.col(f"l.`{k}`").eqNullSafe(F.col(f"r.`{k}`"))
    joined = states.alias("l").join(centred.alias("r"), alike).select("l.*", "_mean")
    return joined.groupBy(*keys).agg(
        total.alias("count"), F.sum("nulls").alias("nulls"), F.first("_mean").alias("mean"),
        F.sum(F.col("m2") + F.col("count") * apart * apart).alias("m2"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.kll_merge_agg_double("ranks", F.lit(SKETCH)).alias("ranks"), F.hll_union_agg("values").alias("values"),
    )


def describe_states(
    states: DataFrame, rows: DataFrame | None = None, probs: Sequence[float] = QUARTILES
) -> DataFrame:
    """Statistics of each column from merged states, one per column; ``distinct`` is an estimate, null if not kept.

    With ``rows``, the rows that the states are of, quantiles are exact:
    sketches bracket the wanted ranks, values inside brackets (some hundredths
    of the rows) are taken out and counted, all others are counted where they
    stand, and ``_with_quantiles`` ranks them. Without ``rows`` quantiles are
    those of the sketches.
    """
    n, names = len(probs), [_name(p) for p in probs]
    some = F.col("count") > 0

    def at(p: float) -> Column:
        return F.when(some, F.kll_sketch_get_quantile_double("ranks", F.lit(min(max(p, 0.0), 1.0))))

    few = F.col("count") <= SKETCH
    found = [
        *(at(p).alias(name) for p, name in zip(probs, names)),
        *(F.when(few, F.col("min")).otherwise(at(p - MARGIN)).alias(f"lo{i}") for i, p in enumerate(probs)),
        *(F.when(few, F.col("max")).otherwise(at(p + MARGIN)).alias(f"hi{i}") for i, p in enumerate(probs)),
    ]
    stats = states.select(
        "column", "count", "nulls", F.hll_sketch_estimate("values").alias("distinct"), "mean",
        F.when(F.col("count") > 1, F.sqrt(F.col("m2") / (F.col("count") - 1))).alias("std"), "min", *found, "max",
    )
    # One row per column; its numbers become part of the next plan.
    known, shape = stats.collect(), stats.schema
    stats = states.sparkSession.createDataFrame(known, shape)
    result = ["column", "count", "nulls", "distinct", "mean", "std", "min", *names, "max"]
    if rows is None or not known:
        return stats.select(*result)

    cols = [r["column"] for r in known]
    cells = rows.select(*(cell.alias(f"c{i}") for i, cell in enumerate(_numbers(rows, cols))))
    kept, between = [], []
    for k, r in enumerate(known):
        value, inside, passed = F.col(f"c{k}"), F.lit(False), F.lit(0)
        if not r["count"]:
            continue
        for i in range(n):
            inside = inside | value.between(r[f"lo{i}"], r[f"hi{i}"])
            passed = passed + (value > r[f"hi{i}"]).cast("int")
        kept.append(F.when(inside, F.struct(F.lit(r["column"]).alias("column"), passed.alias("passed"), value.alias("v"))))
        between += [
            F.struct(
                F.lit(r["column"]).alias("column"), F.lit(i).alias("passed"), F.lit(None).cast("double").alias("v"),
                F.count_if(value.isNotNull() & ~inside & (passed == i)).alias("n"),
            ) for i in range(n + 1)
        ]
    if not kept:
        return stats.select(*result)
    taken = cells.select(F.inline(F.filter(F.array(*kept), lambda x: x.isNotNull())))
    counted = taken.groupBy("column", "passed", "v").agg(F.count(F.lit(1)).alias("n"))
    others = cells.agg(F.array(*between).alias("all")).select(F.inline("all")).where("n > 0")
    ends = stats.select("column", *(f"{end}{i}" for i in range(n) for end in ("lo", "hi")))
    plain = stats.select("column", "count", "mean", "std", "min", "max")
    exact = _with_quantiles(plain, counted.unionByName(others), ends, probs)
    return exact.join(F.broadcast(stats.select("column", "nulls", "distinct")), "column").select(*result)


def text_stats(long: DataFrame) -> DataFrame:
    """Count, distinct values, most frequent value and its count of (column, value).

    Counting per value first keeps map-side combining; ties take the
    smallest value.
    """
    counts = long.groupBy("column", "value").agg(F.count("value").alias("n"))
    best = F.min(F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("n"), F.col("value"))))
    return counts.groupBy("column").agg(
        F.sum("n").alias("count"), F.count("value").alias("unique"), best.alias("_best")
    ).select(
        "column", "count", "unique",
        F.col("_best.value").alias("top"), (-F.col("_best.n")).alias("freq"),
    )


def describe_all(df: DataFrame, exact: bool = True) -> DataFrame:
    """One row per column: dtype, count, unique, top, freq, mean ... max.

    As in pandas, numbers have moments and quantiles, everything else has
    unique, top and freq. NaN counts as missing.
    """
    numeric = [f.name for f in df.schema.fields if is_numeric(f.dataType)]
    other = [f.name for f in df.schema.fields if not is_numeric(f.dataType)]
    parts = []
    if numeric:
        parts.append(describe_states(profile_states(df, numeric, distinct=False), df if exact else None).drop("nulls", "distinct"))
    if other:
        flat = df.select(*(
            (F.to_json(f"`{f.name}`") if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
             else F.col(f"`{f.name}`")).alias(f.name)
            for f in df.schema.fields if f.name in other
        ))
        parts.append(text_stats(_long(flat, other, "string")))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    for name, dtype in {"unique": "bigint", "top": "string", "freq": "bigint", "mean": "double",
                        "std": "double", "min": "double", "p25": "double", "p50": "double",
                        "p75": "double", "max": "double"}.items():
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(dtype))
    dtypes = F.create_map(*(F.lit(x) for pair in df.dtypes for x in pair))
    return rows.select(
        "column", dtypes[F.col("column")].alias("dtype"),
        "count", "unique", "top", "freq", "mean", "std", "min", "p25", "p50", "p75", "max",
    )


def describe_numeric(df: DataFrame, c: str, flatten: bool = False, exact: bool = True) -> DataFrame:
    """Describe one numeric column, or the items of a numeric array column."""
    values = F.explode(F.col(f"`{c}`")) if flatten else F.col(f"`{c}`")
    return describe_all(df.select(values.alias(c)), exact=exact)


def profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """``describe_all`` plus the number of NULLs per column. The frame is read several times, so it is written first."""
    from marquee.sinks.staging import stage

    df = stage(df)
    return describe_all(df, exact).join(F.broadcast(null_counts(df)), "column", "left")


class ColumnReport(NamedTuple):
    """NULL rows, rows with repeated values, and the counts of those values."""

    nulls: DataFrame
    duplicates: DataFrame
    duplicate_counts: DataFrame


def analyze_column(df: DataFrame, c: str) -> ColumnReport:
    """What is missing and what is repeated in one column."""
    return ColumnReport(null_rows(df, c), all_duplicates(df, c), value_counts(df, c, min_count=2))


class ColumnValues(NamedTuple):
    """How a column was handled, and its statistics or distinct values."""

    kind: str
    frame: DataFrame | None


def unique_values(df: DataFrame) -> dict[str, ColumnValues]:
    """Per column: statistics for numbers, distinct values for text.

    Arrays are treated by their items. Other types are not handled.
    """
    result = {}
    for field in df.schema.fields:
        c, dtype = field.name, field.dataType
        if isinstance(dtype, T.ArrayType) and is_numeric(dtype.elementType):
            result[c] = ColumnValues("numeric array", describe_numeric(df, c, flatten=True))
        elif isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StringType):
            result[c] = ColumnValues("text array", distinct_values(df, c, flatten=True))
        elif is_numeric(dtype):
            result[c] = ColumnValues("numeric", describe_numeric(df, c))
        elif isinstance(dtype, T.StringType):
            result[c] = ColumnValues("text", distinct_values(df, c))
        else:
            result[c] = ColumnValues("not handled", None)
    return result
