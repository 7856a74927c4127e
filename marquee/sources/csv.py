"""CSV readers that keep text as text and align files by header, not by position."""

from __future__ import annotations

import csv
import logging
import re
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions.text import PANDAS_NA, null_if_in
from marquee.operators.columns import union_relaxed

log = logging.getLogger(__name__)

YEAR_PATTERN = "merged_movies_data_*.csv"
# Header lines read at the same time.
HEADER_READERS = 16
# A first line is looked for in so many bytes of a file, and at most so many.
HEADER_BYTES, MOST_HEADER_BYTES = 1 << 16, 1 << 20


def _reader(spark: SparkSession, multi_line: bool):
    # Doubled quotes, and line breaks inside quotes, as pandas writes them.
    return spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    na_tokens: Iterable[str] | None = PANDAS_NA,
    multi_line: bool = True,
) -> DataFrame:
    """CSV files with one common header, every column as text.

    Cells that are one of ``na_tokens`` become NULL; ``None`` keeps them. Set
    ``multi_line`` to False for files without quoted line breaks: only then
    can one file be read by several tasks.
    """
    df = _reader(spark, multi_line).csv(paths)
    if na_tokens is None:
        return df
    tokens = tuple(na_tokens)
    return df.select(*(null_if_in(F.col(f"`{c}`"), tokens).alias(c) for c in df.columns))


class UnreadableHeader(ValueError):
    """A file whose first line cannot be a header."""


class YearFiles(NamedTuple):
    """Files by header, and the files that could not be read with the reason."""

    by_header: dict[tuple[str, ...], list[str]]
    skipped: dict[str, str]


def list_year_files(spark: SparkSession, root: str, pattern: str = YEAR_PATTERN) -> list[str]:
    """Matching files in the direct sub-folders of ``root``.

    Spark lists them, so any file system it knows will do. File contents are
    not read, as only the path column is selected.
    """
    try:
        files = spark.read.format("binaryFile").load(f"{root.rstrip('/')}/*/{pattern}").select("path")
    except AnalysisException:
        return []
    return sorted(row.path for row in files.collect())


def _plain_header(spark: SparkSession, path: str) -> tuple[str, ...] | None:
    """Names in a file's first line, read without a job; None if only Spark's reader can tell them."""
    jvm = spark.sparkContext._jvm
    if path.endswith((".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate")):
        return None
    file = jvm.org.apache.hadoop.fs.Path(path)
    stream = file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(file)
    try:
        head, whole = b"", False
        for size in (HEADER_BYTES, MOST_HEADER_BYTES - HEADER_BYTES):
            more = bytes(stream.readNBytes(size))
            head, whole = head + more, len(more) < size
            if whole or b"\n" in more or b"\r" in more:
                break
        else:
            raise UnreadableHeader(f"no line break in the first {MOST_HEADER_BYTES} bytes")
    finally:
        stream.close()
    first = re.split(rb"[\r\n]", head, maxsplit=1)[0]
    try:
        line = first.decode()
    except UnicodeDecodeError:
        return None
    if not line or line.startswith("\ufeff") or line.count('"') % 2:
        return None
    names = tuple(next(csv.reader([line])))
    plain = all(names) and len({n.lower() for n in names}) == len(names)
    return names if plain else None


def group_by_header(spark: SparkSession, paths: Sequence[str], multi_line: bool = True) -> YearFiles:
    """Group files by header line. Spark aligns files of one read by position.

    Headers are read from the files' first lines, at the same time and without
    a job each; of a file without line breaks no more than a bounded beginning
    is read. Spark's reader is asked only where the line alone does not tell
    the names.
    """

    def header(path: str) -> tuple[str, tuple[str, ...] | None, str]:
        try:
            names = _plain_header(spark, path) or tuple(_reader(spark, multi_line).csv(path).columns)
            return path, names or None, "no header"
        except (PySparkException, Py4JError, UnreadableHeader) as e:
            return path, None, str(getattr(e, "java_exception", e)).splitlines()[0]

    groups: dict[tuple[str, ...], list[str]] = {}
    skipped: dict[str, str] = {}
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        for path, names, reason in pool.map(header, paths):
            if names is None:
                log.warning("skipping %s: %s", path, reason)
                skipped[path] = reason
            else:
                groups.setdefault(names, []).append(path)
    return YearFiles(groups, skipped)


class CsvRead(NamedTuple):
    """Rows of the readable files, and the others with the reason."""

    rows: DataFrame
    skipped: dict[str, str]


class UnreadableFiles(ValueError):
    """Files that were to be read and could not be."""

    def __init__(self, skipped: dict[str, str]):
        shown = "; ".join(f"{path}: {why}" for path, why in list(skipped.items())[:5])
        super().__init__(f"{len(skipped)} unreadable CSV files: {shown}")
        self.skipped = skipped


def scan_csv_files(
    spark: SparkSession,
    paths: Sequence[str],
    *,
    na_tokens: Iterable[str] | None = None,
    multi_line: bool = True,
) -> CsvRead:
    """CSV files whose headers may differ, united by column name; tells which could not be read.

    Adds ``src_year`` (from a four-digit folder), ``_src_file`` and
    ``_src_pos``. The three together order rows as they stand in the files.
    """
    found = group_by_header(spark, paths, multi_line)
    if not found.by_header:
        raise UnreadableFiles(found.skipped)
    frames = []
    for names, files in found.by_header.items():
        schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
        cells = [F.col(f"`{c}`") for c in names]
        if na_tokens is not None:
            tokens = tuple(na_tokens)
            cells = [null_if_in(cell, tokens).alias(c) for cell, c in zip(cells, names)]
        path = F.col("_metadata.file_path")
        frames.append(
            _reader(spark, multi_line).schema(schema).csv(files).select(
                *cells,
                F.regexp_extract(path, r"/(?:src_year=)?(\d{4})/[^/]*\z", 1).try_cast("int").alias("src_year"),
                F.col("_metadata.file_name").alias("_src_file"),
                # Blocks of one file are packed into tasks by size, so the row
                # id alone does not follow the file.
                F.struct(
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"),
                ).alias("_src_pos"),
            )
        )
    return CsvRead(union_relaxed(frames), found.skipped)


def read_csv_files(
    spark: SparkSession,
    paths: Sequence[str],
    *,
    na_tokens: Iterable[str] | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """``scan_csv_files`` for files that must all be readable; else it raises ``UnreadableFiles``."""
    found = scan_csv_files(spark, paths, na_tokens=na_tokens, multi_line=multi_line)
    if found.skipped:
        raise UnreadableFiles(found.skipped)
    return found.rows


def scan_years(
    spark: SparkSession,
    root: str,
    pattern: str = YEAR_PATTERN,
    *,
    na_tokens: Iterable[str] | None = None,
    multi_line: bool = True,
) -> CsvRead:
    """All yearly files below ``root``, and which of them could not be read."""
    paths = list_year_files(spark, root, pattern)
    if not paths:
        raise ValueError(f"no file {pattern} in the sub-folders of {root}")
    return scan_csv_files(spark, paths, na_tokens=na_tokens, multi_line=multi_line)


def read_years(
    spark: SparkSession,
    root: str,
    pattern: str = YEAR_PATTERN,
    *,
    na_tokens: Iterable[str] | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Rows of all readable yearly files below ``root``; the others are logged. ``scan_years`` returns them."""
    return scan_years(spark, root, pattern, na_tokens=na_tokens, multi_line=multi_line).rows
