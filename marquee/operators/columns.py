"""Operators on the column set: renaming, ordering, alignment, swaps, narrow types."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map; names that the frame lacks are ignored.

    Column names are compared in composed Unicode form.
    """
    names = [unicodedata.normalize("NFC", c) for c in df.columns]
    renamed = [mapping.get(c, c) for c in names]
    twice = sorted({c for c in renamed if renamed.count(c) > 1})
    if twice:
        raise ValueError(f"several columns would be named {twice}")
    return df.toDF(*renamed)


def lead_columns(df: DataFrame, first: Sequence[str] = ("id", "title")) -> DataFrame:
    """Move the named columns to the front; the others keep their order."""
    rest = [c for c in df.columns if c not in first]
    return df.select(*(F.col(f"`{c}`") for c in (*first, *rest)))


def unexpected_columns(df: DataFrame, schema: T.StructType | Iterable[str]) -> list[str]:
    """Columns that the target schema does not know. They are kept, not dropped."""
    known = set(schema.names if isinstance(schema, T.StructType) else schema)
    return [c for c in df.columns if c not in known]


def absent_columns(df: DataFrame, schema: T.StructType | Iterable[str]) -> list[str]:
    """Columns of the target schema that the frame lacks."""
    names = schema.names if isinstance(schema, T.StructType) else schema
    return [c for c in names if c not in df.columns]


def swap_where(df: DataFrame, a: str, b: str, cond: Column) -> DataFrame:
    """Exchange two columns on the rows where ``cond`` is true."""
    swap = F.coalesce(cond, F.lit(False))
    left, right = F.col(f"`{a}`"), F.col(f"`{b}`")
    return df.withColumns({
        a: F.when(swap, right).otherwise(left),
        b: F.when(swap, left).otherwise(right),
    })


def _common_type(types: list[T.DataType]) -> T.DataType:
    """Type that holds every value of all the given ones; text if nothing else does."""
    distinct = list(dict.fromkeys(t for t in types if not isinstance(t, T.NullType)))
    if len(distinct) <= 1:
        return distinct[0] if distinct else T.StringType()
    whole = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
    if all(type(t) in whole for t in distinct):
        return max(distinct, key=lambda t: whole.index(type(t)))
    if all(isinstance(t, (*whole, T.FloatType, T.DoubleType)) for t in distinct):
        return T.DoubleType()
    return T.StringType()


def union_relaxed(dfs: Sequence[DataFrame]) -> DataFrame:
    """Union all by name; absent columns become NULL, unlike types are widened.

    Widening happens before the union: Spark would cast text to the number
    type instead, and then fail on text that is no number.
    """
    if not dfs:
        raise ValueError("nothing to unite")
    types: dict[str, list[T.DataType]] = {}
    for df in dfs:
        for field in df.schema.fields:
            types.setdefault(field.name, []).append(field.dataType)
    target = {name: _common_type(seen) for name, seen in types.items()}

    def aligned(df: DataFrame) -> DataFrame:
        return df.select(*(
            (F.col(f"`{name}`") if name in df.columns else F.lit(None)).cast(dtype).alias(name)
            for name, dtype in target.items()
        ))

    return reduce(DataFrame.unionAll, [aligned(df) for df in dfs])


# Types that hold every value which the parsers of these columns can give, so
# the casts cannot fail. ``fit`` finds narrower ones.
FIXED_TYPES = {"year": "int", "duration": "bigint", "votes": "bigint", "meta_score": "bigint"}


def narrow_ints(
    df: DataFrame,
    cols: Sequence[str],
    mode: str = "fixed",
    types: Mapping[str, str] = FIXED_TYPES,
) -> DataFrame:
    """Cast integer columns to a narrower type.

    ``fixed`` uses the given type per column and costs nothing. ``fit`` runs
    one aggregation over all columns and picks the smallest type that holds
    every value.
    """
    if mode == "fixed":
        target = {c: types[c] for c in cols}
    elif mode == "fit":
        ends = df.agg(
            *(F.min(f"`{c}`").alias(f"lo_{i}") for i, c in enumerate(cols)),
            *(F.max(f"`{c}`").alias(f"hi_{i}") for i, c in enumerate(cols)),
        ).first()
        target = {c: _smallest(ends[f"lo_{i}"], ends[f"hi_{i}"]) for i, c in enumerate(cols)}
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return df.withColumns({c: F.col(f"`{c}`").cast(t) for c, t in target.items()})


def _smallest(lo: int | None, hi: int | None) -> str:
    for bits, name in ((7, "tinyint"), (15, "smallint"), (31, "int")):
        if lo is None or (lo >= -(2**bits) and hi < 2**bits):
            return name
    return "bigint"
