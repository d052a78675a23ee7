"""A batch sink as a Spark data source: Arrow batches, all or nothing.

Tasks write Parquet files of bounded size to a folder of their own below `_staged`, which readers don't see. When all tasks are
done, files of attempts that count move into one folder, and that folder becomes visible by one rename. If the write fails, or an attempt of
a task is lost, nothing of it is ever visible. A task that outlives its failed job may leave files below `_staged`; they are
never read and can be removed when no write is under way.

    df.write.format("staged_files").option("path", path).option("batch_rows", 10000).mode("append").save()
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

#: Sinks travel to the executors by value: this package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "staged_files"
BATCH_ROWS = 10_000


def filesystem(uri: str):
    """The pyarrow file system of a path as Hadoop spells it, and the path within."""
    from pyarrow import fs

    for prefix, plain in (("file:///", "/"), ("file:/", "/"), ("s3a://", "s3://")):
        if uri.startswith(prefix):
            uri = plain + uri[len(prefix):]
            break
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


@dataclass
class Attempt(WriterCommitMessage):
    """What an attempt of a task has staged."""

    folder: str
    rows: int


class StagedWriter(DataSourceArrowWriter):
    def __init__(self, uri: str, batch_rows: int, overwrite: bool):
        self.uri, self.batch_rows, self.overwrite = uri, batch_rows, overwrite
        self.job = uuid.uuid4().hex

    def _batches(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """Tables of `batch_rows` rows, the last one smaller; one and the rest of a batch are in memory."""
        waiting: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            while rows + batch.num_rows >= self.batch_rows:
                taken = self.batch_rows - rows
                yield pa.Table.from_batches([*waiting, batch.slice(0, taken)])
                batch, waiting, rows = batch.slice(taken), [], 0
            if batch.num_rows:
                waiting.append(batch)
                rows += batch.num_rows
        if rows:
            yield pa.Table.from_batches(waiting)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyarrow import parquet

        system, root = filesystem(self.uri)
        task = TaskContext.get()
        folder = f"{root}/_staged/{self.job}/{task.partitionId():06d}-{task.taskAttemptId()}"
        total = 0
        for i, table in enumerate(self._batches(iterator)):
            if not i:
                system.create_dir(folder, recursive=True)
            parquet.write_table(table, f"{folder}/part-{task.partitionId():06d}-{i:06d}.parquet", filesystem=system)
            total += table.num_rows
        return Attempt(folder, total)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        from pyarrow import fs

        system, root = filesystem(self.uri)
        system.create_dir(root, recursive=True)
        before = [x.path for x in system.get_file_info(fs.FileSelector(root)) if not x.base_name.startswith(("_", "."))]
        whole = f"{root}/_staged/{self.job}-whole"
        system.create_dir(whole, recursive=True)
        for message in messages:
            if message is not None and message.rows:
                for file in system.get_file_info(fs.FileSelector(message.folder)):
                    system.move(file.path, f"{whole}/{file.base_name}")
        system.move(whole, f"{root}/{self.job}")
        self.abort(messages)
        for path in before if self.overwrite else ():
            remove = system.delete_file if system.get_file_info(path).type == fs.FileType.File else system.delete_dir
            remove(path)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        from pyarrow import fs

        system, root = filesystem(self.uri)
        for folder in (f"{root}/_staged/{self.job}", f"{root}/_staged/{self.job}-whole"):
            if system.get_file_info(folder).type == fs.FileType.Directory:
                system.delete_dir(folder)


class StagedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        rows = int(self.options.get("batch_rows", BATCH_ROWS))
        if rows < 1:
            raise ValueError("batch_rows must be positive")
        return StagedWriter(self.options["path"], rows, overwrite)


def write_staged(df: DataFrame, path: str, batch_rows: int = BATCH_ROWS, overwrite: bool = False) -> int:
    """Adds the rows to the files below a path, or replaces them; returns the rows written. Rows are counted where
    they are written, an attempt that is lost not at all."""
    df.sparkSession.dataSource.register(StagedFiles)
    counted = Observation()
    rows = df.observe(counted, F.count(F.lit(1)).alias("n"))
    writer = rows.write.format(NAME).option("path", path).option("batch_rows", batch_rows)
    writer.mode("overwrite" if overwrite else "append").save()
    return counted.get["n"]


def read_staged(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)
