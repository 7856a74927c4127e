"""Yearly refresh: pick up new files, clean them, and merge them into a store of buckets.

The store holds one row per id. Ids are dealt to buckets by hash, and a batch
reads and rewrites only the buckets that its ids fall into, as new folders
beside the old ones. A manifest, written last, names the folder of each bucket,
so readers see all of a batch or none of it, and read the store as it stands,
without ranking. Old folders stay until ``prune_store`` deletes them.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marquee.operators.columns import lead_columns
from marquee.operators.dedup import keep_last
from marquee.plans.catalogue import clean_catalogue
from marquee.plans.schemas import BOOKKEEPING
from marquee.sources.csv import YEAR_PATTERN, read_csv_files

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
#: Buckets of a new store. A store keeps its own number.
BUCKETS = 256
BUCKET, VERSION = "_bucket", "version"


class Manifest(NamedTuple):
    """What a store consists of: the version of each bucket that has rows, and the batch that made the latest one."""

    version: int
    buckets: int
    source: str
    batch: int
    versions: dict[int, int]


def _system(spark: SparkSession, path: str):
    file = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), file


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    system, folder = _system(spark, path)
    return [f.getPath().getName() for f in system.listStatus(folder)] if system.exists(folder) else []


def _manifests(spark: SparkSession, store: str) -> list[int]:
    """Versions whose manifest is complete, in order."""
    found = []
    for name in _names(spark, f"{store}/manifests"):
        system, done = _system(spark, f"{store}/manifests/{name}/_SUCCESS")
        if name.startswith(f"{VERSION}=") and system.exists(done):
            found.append(int(name.split("=")[1]))
    return sorted(found)


def read_manifest(spark: SparkSession, store: str) -> Manifest | None:
    """The latest manifest of a store; None before its first batch."""
    store = store.rstrip("/")
    found = _manifests(spark, store)
    if not found:
        return None
    rows = spark.read.parquet(f"{store}/manifests/{VERSION}={found[-1]}").collect()  # one row per bucket
    first = rows[0]
    versions = {r["bucket"]: r["at"] for r in rows if r["bucket"] is not None}
    return Manifest(found[-1], first["buckets"], first["source"], first["batch"], versions)


def _write_manifest(spark: SparkSession, store: str, m: Manifest) -> None:
    rows = [(k, v, m.buckets, m.source, m.batch) for k, v in [(None, None), *sorted(m.versions.items())]]
    frame = spark.createDataFrame(rows, "bucket int, at long, buckets int, source string, batch long").coalesce(1)
    frame.write.mode("overwrite").parquet(f"{store}/manifests/{VERSION}={m.version}")


def _rows(spark: SparkSession, store: str, versions: dict[int, int]) -> DataFrame:
    """Rows of the given buckets. Batches may have added columns, so the files' schemas are merged."""
    paths = [f"{store}/data/{VERSION}={v}/{BUCKET}={k}" for k, v in sorted(versions.items())]
    return spark.read.option("mergeSchema", True).parquet(*paths)


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def merge_batch(
    spark: SparkSession, cleaned: DataFrame, store: str, batch: int = 0, source: str = "", buckets: int = BUCKETS
) -> list[int]:
    """Merge cleaned rows into the store; the buckets that were rewritten.

    The last row per id stays. A batch of a source that the store has merged
    already changes nothing, and one that was cut short is merged anew.
    """
    from marquee.sinks.staging import stage

    store = store.rstrip("/")
    old = read_manifest(spark, store) or Manifest(-1, buckets, "", -1, {})
    if (old.source, old.batch) == (source, batch):
        return []
    bucket = bucket_of(F.col("id"), old.buckets)
    last = stage(keep_last(cleaned, "id", BOOKKEEPING).withColumn(BUCKET, bucket))
    touched = sorted(r[0] for r in last.select(BUCKET).distinct().collect())  # at most one row per bucket
    if touched:
        merged = last
        before = {k: old.versions[k] for k in touched if k in old.versions}
        if before:
            known = _rows(spark, store, before).withColumn(BUCKET, bucket)
            merged = keep_last(last.unionByName(known, allowMissingColumns=True), "id", BOOKKEEPING)
        # A large bucket is written by several tasks.
        merged.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(
            f"{store}/data/{VERSION}={old.version + 1}"
        )
    versions = old.versions | dict.fromkeys(touched, old.version + 1)
    _write_manifest(spark, store, Manifest(old.version + 1, old.buckets, source, batch, versions))
    return touched


def refresh_catalogue(
    spark: SparkSession,
    root: str,
    store: str,
    checkpoint: str,
    pattern: str = YEAR_PATTERN,
    files_per_batch: int = 1_000,
    multi_line: bool = True,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Clean the files that arrived since the last run and merge them into ``store``.

    The stream only discovers files, as a CSV stream would align columns by
    position. Each batch reads its files by header, keeps the last row per id
    and merges them by ``merge_batch``, so a repeated batch changes nothing. A
    file that cannot be read fails the batch, which is then not committed: the
    file is read again by the next run. The query ends when all present files
    are handled.
    """
    arrived = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(f"{root.rstrip('/')}/*/{pattern}")
        .select("path")
    )

    def handle(files: DataFrame, batch_id: int) -> None:
        paths = sorted(row.path for row in files.collect())  # at most files_per_batch names
        if not paths:
            return
        session = files.sparkSession
        cleaned = clean_catalogue(read_csv_files(session, paths, multi_line=multi_line))
        merge_batch(session, cleaned, store, batch_id, checkpoint, buckets)

    return (
        arrived.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def prune_store(spark: SparkSession, store: str) -> int:
    """Delete what the latest manifest does not name; the number of folders deleted. Call it when nobody reads older states."""
    store = store.rstrip("/")
    now = read_manifest(spark, store)
    if now is None:
        return 0
    used = {(v, k) for k, v in now.versions.items()}
    old = [f"{store}/manifests/{name}" for name in _names(spark, f"{store}/manifests") if name != f"{VERSION}={now.version}"]
    for name in _names(spark, f"{store}/data"):
        version = int(name.split("=")[1])
        kept = {k for v, k in used if v == version}
        if version > now.version or not kept:
            old.append(f"{store}/data/{name}")
        else:
            folders = [n for n in _names(spark, f"{store}/data/{name}") if n.startswith(f"{BUCKET}=")]
            old += [f"{store}/data/{name}/{n}" for n in folders if int(n.split("=")[1]) not in kept]
    for path in old:
        system, folder = _system(spark, path)
        system.delete(folder, True)
    return len(old)


def current_catalogue(spark: SparkSession, store: str) -> DataFrame:
    """The catalogue over all batches: the last row per id, as in one batch run."""
    now = read_manifest(spark, store)
    if now is None or not now.versions:
        raise ValueError(f"no batch was merged into {store}")
    return lead_columns(_rows(spark, store.rstrip("/"), now.versions), ("id", "title")).drop(*BOOKKEEPING)
