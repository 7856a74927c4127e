"""Small helpers that several operators here share."""

from __future__ import annotations

import re
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.sinks import shared_folder, stage

# Send the module along with the task, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Largest frame that is broadcast, in bytes; a larger one is joined by a shuffle.
BROADCAST_BYTES = 32 << 20

__all__ = ["BROADCAST_BYTES", "ROW", "as_bytes", "empty_text", "numbered", "placed", "shared_folder", "sized", "slices", "stage", "table"]

#: Name of the row number that the operators add; no input column may have it.
ROW = "_llm_row"
#: Names of a row's file and of its index there, while rows are placed; no input column may have them.
FILE, AT = "_llm_file", "_llm_at"
#: A file has at most 2 ** FILE_BITS rows, and there are at most 2 ** (63 - FILE_BITS) files.
FILE_BITS = 40


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def empty_text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def numbered(df: DataFrame, *columns: Column | str) -> DataFrame:
    """``columns`` of ``df`` (all, if none are given) and a number that tells equal rows apart.

    A number that ``df`` has already (see ``placed``) is kept. A new one follows
    from the place of the row in its input split. Splits change with the number
    of cores, so a second reading may give other numbers: write the numbered
    rows before using them twice, or number them by ``placed``.
    """
    if ROW in df.columns:
        return df.select(*columns, ROW) if columns else df
    return (df.select(*columns) if columns else df).withColumn(ROW, F.monotonically_increasing_id())


def _natural(path: str) -> list:
    """Sorts file names by the numbers in them, as Spark numbers the files that it writes."""
    return [int(x) if x.isdigit() else x for x in re.split(r"([0-9]+)", path)]


def _is_parquet(df: DataFrame) -> bool:
    """Whether ``df`` is columns or rows picked from Parquet files, so that each row has a place of its own in a file."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias") and plan.deterministic():
        plan = plan.children().head()
    if plan.nodeName() != "LogicalRelation":
        return False
    try:
        df.select("_metadata.row_index")
    except AnalysisException:
        return False
    return True


def placed(df: DataFrame) -> DataFrame:
    """``df`` with a number that is the same whenever its files are read, and grows in the order of the files.

    It is the file's place among the sorted file names and the row's index in
    the file, whatever splits are read. What is not read from Parquet files is
    written to such files first.
    """
    if ROW in df.columns:
        return df
    if not _is_parquet(df):
        df = stage(df)
    # Spark writes file:/ in one of the two lists and file:/// in the other.
    slashes = r"^([^/:]+):/+"
    files = sorted({re.sub(slashes, r"\1:/", path) for path in df.inputFiles()}, key=_natural)
    known = F.broadcast(df.sparkSession.createDataFrame(
        [(path, k) for k, path in enumerate(files)], f"{FILE} string, {ROW} long"
    ))
    names, at = df.columns, F.col("_metadata.row_index")
    rows = df.select("*", F.regexp_replace("_metadata.file_path", slashes, "$1:/").alias(FILE), at.alias(AT)).join(known, FILE, "left")
    number = F.coalesce(ROW, F.raise_error(F.concat(F.lit("not among the files read: "), FILE)).cast("long"))
    return rows.select(*(rows[f"`{n}`"] for n in names), (F.shiftleft(number, FILE_BITS) + F.col(AT)).alias(ROW))


def sized(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a staged frame for broadcasting if its rows were counted to fit.

    Beyond the limit it is left alone, and Spark joins it by a shuffle.
    """
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(batches, most_bytes: int = 8 << 20, rows: int = 512):
    """Cut record batches into pieces of bounded rows and (but for one long text) bytes."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            n = min(rows, batch.num_rows - at)
            while n > 1 and batch.slice(at, n).nbytes > most_bytes:
                n //= 2
            yield batch.slice(at, n)
            at += n
