"""Arrow IPC (Feather) files as a Spark data source for writing."""

from __future__ import annotations

import os
import posixpath
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Send this module along with the task, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "arrow_ipc"
# A task begins a new file after so many bytes of batches, so readers that take a
# file as a whole have a bounded one.
FILE_BYTES = 256 * 1024 * 1024
# Names that Hadoop has for file systems, and Arrow's for the same.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


@dataclass
class WrittenFiles(WriterCommitMessage):
    """Staged files of one task; none for a task without rows."""

    paths: list[str]
    partition: int


def _locate(path: str) -> tuple[fs.FileSystem, str]:
    scheme, colon, rest = path.partition(":")
    if colon and rest.startswith("/"):
        return fs.FileSystem.from_uri(SCHEMES.get(scheme, scheme) + colon + rest)
    return fs.LocalFileSystem(), os.path.abspath(path)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, resolved as Spark's own writers do.

    Fails here, before any job, if Arrow cannot write to that file system.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    whole = hadoop.makeQualified(system.getUri(), system.getWorkingDirectory()).toString()
    try:
        _locate(whole)
    except (pa.ArrowInvalid, OSError) as e:
        raise ValueError(f"Arrow files cannot be written to {whole}: {e}") from e
    return whole


class ArrowIpcWriter(DataSourceArrowWriter):
    """Files per task, of bounded size. They are staged and moved when all tasks are done."""

    def __init__(self, path: str, schema: StructType, overwrite: bool):
        self.path, self.schema, self.overwrite = path, schema, overwrite
        self.run = uuid.uuid4().hex

    def _staging(self, root: str) -> str:
        return posixpath.join(root, f"_staging-{self.run}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WrittenFiles:
        task = TaskContext.get()
        filesystem, root = _locate(self.path)
        paths, stream, writer, size = [], None, None, 0
        for batch in iterator:
            if writer is not None and size >= FILE_BYTES:
                writer.close()
                stream.close()
                writer, size = None, 0
            if writer is None:
                folder = self._staging(root)
                filesystem.create_dir(folder, recursive=True)
                name = f"{task.partitionId():05d}-{task.taskAttemptId()}-{len(paths):05d}.arrow"
                paths.append(posixpath.join(folder, name))
                stream = filesystem.open_output_stream(paths[-1])
                writer = pa.ipc.new_file(stream, batch.schema)
            writer.write_batch(batch)
            size += batch.nbytes
        if writer is not None:
            writer.close()
            stream.close()
        return WrittenFiles(paths, task.partitionId())

    def commit(self, messages: list[WrittenFiles | None]) -> None:
        filesystem, root = _locate(self.path)
        filesystem.create_dir(root, recursive=True)
        if self.overwrite:
            for entry in filesystem.get_file_info(fs.FileSelector(root)):
                if entry.base_name.startswith("part-") and entry.base_name.endswith(".arrow"):
                    filesystem.delete_file(entry.path)
        written = [
            (path, f"part-{m.partition:05d}-{k:05d}-{self.run}.arrow")
            for m in sorted((m for m in messages if m), key=lambda m: m.partition) for k, path in enumerate(m.paths)
        ]
        for path, name in written:
            filesystem.move(path, posixpath.join(root, name))
        if not written:
            with filesystem.open_output_stream(posixpath.join(root, f"part-00000-00000-{self.run}.arrow")) as stream:
                pa.ipc.new_file(stream, to_arrow_schema(self.schema)).close()
        self._clear(filesystem, root)
        filesystem.open_output_stream(posixpath.join(root, "_SUCCESS")).close()

    def abort(self, messages: list[WrittenFiles | None]) -> None:
        self._clear(*_locate(self.path))

    def _clear(self, filesystem: fs.FileSystem, root: str) -> None:
        staging = self._staging(root)
        if filesystem.get_file_info(staging).type != fs.FileType.NotFound:
            filesystem.delete_dir(staging)


class ArrowIpcSource(DataSource):
    """``df.write.format("arrow_ipc").mode("overwrite").save(path)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> ArrowIpcWriter:
        return ArrowIpcWriter(self.options["path"], schema, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to the session."""
    spark.dataSource.register(ArrowIpcSource)
