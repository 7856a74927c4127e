"""Results written once and read many times."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(df: DataFrame) -> str:
    """The cluster's checkpoint folder; a temporary one only in local mode."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="marquee-")


#: Tables that this process has staged and not dropped.
_staged: list[str] = []


def stage(df: DataFrame) -> DataFrame:
    """Write the frame as Parquet to the shared folder and read it back.

    Later reads prune columns and do not recompute, also after executors are
    lost.
    """
    path = f"{shared_folder(df).rstrip('/')}/marquee-{uuid.uuid4().hex}"
    _staged.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> int:
    """Delete the tables that this process has staged; results that read them are lost. Returns their number.

    Call it when the results of a run are written or no longer wanted.
    """
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    dropped = 0
    while _staged:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_staged.pop())
        dropped += path.getFileSystem(hadoop).delete(path, True)
    return dropped
