"""Stored HTML pages as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Rows dealt evenly, or by columns, to enough tasks for the whole cluster.

    One file of few row groups is read by few tasks, and everything up to the
    next shuffle runs in them. Deal the rows out while they are narrow, before
    pages are put together or parsed.
    """
    spark = df.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)
    return df.repartition(tasks, *by)


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Pages as ``page_id``, ``url``, ``html``.

    ``parquet`` reads a table with these columns; other columns, such as
    ``src_year``, are kept. ``files`` reads one page per file, with its path
    as ``url`` and a hash of the path as ``page_id``.
    """
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt == "files":
        text = spark.read.text(path, wholetext=True)
        url = F.col("_metadata.file_path")
        return text.select(F.xxhash64(url).alias("page_id"), url.alias("url"), F.col("value").alias("html"))
    raise ValueError(f"unknown page format {fmt!r}")
