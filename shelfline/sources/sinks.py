"""Idempotent partition publishing, write verification and batched external sinks."""

from __future__ import annotations

import gzip
import json
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice

from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from shelfline.session import shuffles_dropped
from shelfline.sources.files import catalog_partitions, drop_partitions, list_partitions
from shelfline.sources.tables import partition_values, read_published


MODE = "partitionOverwriteMode"


def _by_partition(df: DataFrame, part: str, sort_by: str | None, rebalance: bool) -> DataFrame:
    """Few well-sized files per partition value. REBALANCE lets AQE split a partition value that
    holds much of the data over several tasks, and merge small ones."""
    out = df.hint("rebalance", F.col(part)) if rebalance else df
    return out.sortWithinPartitions(part, sort_by) if sort_by else out


def _observed(df: DataFrame, part: str) -> tuple[DataFrame, Observation]:
    """Counts rows and notes the partition values as they are written. Placed above any shuffle, in the writing stage: a shuffle
    stage that is run again after an executor loss would count its rows twice."""
    written = Observation()
    parts = F.collect_set(F.col(part).cast("string")).alias("parts")
    return df.observe(written, F.count(F.lit(1)).alias("n"), parts), written


def publish_partitions(
    df: DataFrame, path: str, part: str = "dt", sort_by: str | None = None, rebalance: bool = True,
    replaced: list[str] | None = None, group_rows: int | None = None, codec: str | None = None,
) -> int:
    """Replace exactly the partitions present in `df`; returns the rows written. Of the values in
    `replaced`, those without a row in `df` are dropped.

    `group_rows` is the most rows of a row group. Readers decode up to 4,096 rows of a row group at a time, which are
    gigabytes where a row holds a document; set it for such tables. `codec` is how files are compressed, if not as the session
    has it. The shuffle files of the write go with it.

    `rebalance` shuffles rows to their partition value. Turn it off for input known to come value by
    value in large files: the write is then shuffle-free, but each task writes a file per value it holds.

    Re-running a publish gives the same table. Parquet offers no snapshot isolation: readers of
    a partition being replaced may see it change; use a catalog table format where that matters.
    """
    counted, written = _observed(_by_partition(df, part, sort_by, rebalance), part)
    writer = counted.write.mode("overwrite").option(MODE, "dynamic").partitionBy(part)
    if group_rows:
        writer = writer.option("parquet.block.row.count.limit", group_rows)
    if codec:
        writer = writer.option("compression", codec)
    with shuffles_dropped(df.sparkSession):
        writer.parquet(path)
    if replaced:
        empty = set(replaced) - {str(v) for v in written.get["parts"]}
        drop_partitions(df.sparkSession, path, sorted(empty), part)
    return written.get["n"]


def publish_table(
    df: DataFrame, table: str, part: str = "dt", provider: str = "parquet",
    location: str | None = None, rebalance: bool = True,
) -> int:
    """Create the partitioned catalog table if absent, else replace the partitions in `df`."""
    spark = df.sparkSession
    columns = [c for c in df.columns if c != part]
    if spark.catalog.tableExists(table):
        # Inserts match by position: the table's order counts, and the names must be the same.
        stored = spark.table(table).columns
        if sorted(stored) != sorted(df.columns):
            raise ValueError(f"{table} has columns {stored}, not {df.columns}")
        columns = [c for c in stored if c != part]
    out, written = _observed(_by_partition(df.select(*columns, part), part, None, rebalance), part)
    if not spark.catalog.tableExists(table):
        creation = out.writeTo(table).using(provider).partitionedBy(F.col(part))
        if provider == "parquet":
            # Built-in tables take no writeTo().overwritePartitions(), and insertInto no mode of its own: the table says
            # how it is overwritten, so that no session setting is changed under other writers.
            creation = creation.option(MODE, "dynamic")
        (creation.option("path", location) if location else creation).create()
    elif provider == "parquet":
        out.write.insertInto(table, overwrite=True)
    else:
        out.writeTo(table).overwritePartitions()
    return written.get["n"]


def partition_counts(df: DataFrame, part: str = "dt") -> DataFrame:
    return df.groupBy(part).agg(F.count(F.lit(1)).alias("n_rows"))


def count_report(expected: DataFrame, actual: DataFrame, part: str = "dt") -> DataFrame:
    """Expected and actual rows per partition; a partition missing on one side counts 0 there."""
    left = partition_counts(expected, part).withColumnRenamed("n_rows", "expected_rows")
    right = partition_counts(actual, part).withColumnRenamed("n_rows", "actual_rows")
    return left.join(right, part, "full_outer").select(
        part,
        F.coalesce("expected_rows", F.lit(0)).alias("expected_rows"),
        F.coalesce("actual_rows", F.lit(0)).alias("actual_rows"),
    )


def verify_counts(expected: DataFrame, actual: DataFrame, part: str = "dt") -> None:
    """Fail when any partition differs in its row count."""
    wrong = count_report(expected, actual, part).filter("expected_rows <> actual_rows")
    found = wrong.collect()  # partitions, not rows
    if found:
        raise ValueError(f"row counts differ after write: {[r.asDict() for r in found]}")


def verify_written(target: DataFrame, written: int, name: str) -> None:
    """Compare the rows now in the published partitions with the count of the write. On Parquet
    this reads file footers only."""
    found = target.count()
    if found != written:
        raise ValueError(f"{name}: wrote {written} rows, found {found}")


@dataclass(frozen=True)
class PathTarget:
    """A published folder whose partitions are replaced and dropped as a whole."""

    spark: SparkSession
    path: str
    part: str = "dt"

    def partitions(self) -> set[str]:
        return set(list_partitions(self.spark, self.path, self.part))

    def replace(self, df: DataFrame, values: list[str]) -> int:
        """Rows of exactly these partition values, as read from a table partitioned alike."""
        written = publish_partitions(df, self.path, self.part)
        found = read_published(self.spark, self.path, df.schema, values, self.part)
        verify_written(found, written, self.path)
        return written

    def drop(self, values: list[str]) -> None:
        drop_partitions(self.spark, self.path, values, self.part)


@dataclass(frozen=True)
class TableTarget:
    """The same for a partitioned catalog table, created by the first write."""

    spark: SparkSession
    table: str
    provider: str = "parquet"
    part: str = "dt"

    def partitions(self) -> set[str]:
        if not self.spark.catalog.tableExists(self.table):
            return set()
        if self.provider == "parquet":
            # The catalog knows them: no row is read.
            return set(catalog_partitions(self.spark, self.table))
        return set(partition_values(self.spark.table(self.table), self.part))

    def replace(self, df: DataFrame, values: list[str]) -> int:
        written = publish_table(df, self.table, self.part, self.provider)
        found = self.spark.table(self.table).filter(F.col(self.part).isin(values))
        verify_written(found, written, self.table)
        return written

    def drop(self, values: list[str]) -> None:
        for value in (v.replace("\\", "\\\\").replace("'", "\\'") for v in values):
            if self.provider == "parquet":
                self.spark.sql(
                    f"ALTER TABLE {self.table} DROP IF EXISTS PARTITION ({self.part} = '{value}')"
                )
            else:
                self.spark.sql(f"DELETE FROM {self.table} WHERE {self.part} = '{value}'")


# Sinks travel to the executors by value: this package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class FileStore:
    """Connection target on any file system pyarrow can reach from the executors."""

    def __init__(self, uri: str):
        # Hadoop spells local and S3 paths differently
        for prefix, plain in (("file:///", "/"), ("file:/", "/"), ("s3a://", "s3://")):
            if uri.startswith(prefix):
                uri = plain + uri[len(prefix):]
                break
        self.uri = uri

    def write(self, name: str, text: str) -> None:
        """A file whose name ends in .gz is compressed."""
        from pyarrow import fs

        data = text.encode("utf-8")
        if name.endswith(".gz"):
            data = gzip.compress(data, 6, mtime=0)

        system, root = fs.FileSystem.from_uri(self.uri)
        target = f"{root}/{name}"
        system.create_dir(target.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(target, compression=None) as out:
            out.write(data)


class JsonLines(FileStore):
    """One JSON-lines file per batch, named by task and batch, so a retried task overwrites."""

    def __call__(self, task: int, batch: int, rows: list[dict]) -> None:
        lines = [json.dumps(r, ensure_ascii=False, default=str) for r in rows]
        self.write(f"task-{task:06d}-{batch:06d}.json", "\n".join(lines) + "\n")


class PageFiles(FileStore):
    """One file per (dt, page) row in the landing layout, page=NNNN.json, or page=NNNN.json.gz if `zipped`."""

    def __init__(self, uri: str, request: str = "all", zipped: bool = False):
        super().__init__(uri)
        self.request = request
        self.suffix = ".json.gz" if zipped else ".json"

    def __call__(self, task: int, batch: int, rows: list[dict]) -> None:
        for r in rows:
            name = f"request={self.request}/dt={r['dt']}/page={r['page']:04d}{self.suffix}"
            self.write(name, r["payload"])


Insert = Callable[[int, int, list[dict]], None]


def write_in_batches(df: DataFrame, insert: Insert, batch_rows: int = 10_000) -> int:
    """Partition-parallel sink: every task hands bounded batches to `insert(task, batch, rows)`.

    `insert` is pickled to the executors and opens its own connection there. At most one batch is
    in memory per task. Returns the rows written; an accumulator used in an action counts each
    task once, also when it is retried. Inserts should be idempotent per (task, batch). The shuffle files of the write go with it.
    """
    total = df.sparkSession.sparkContext.accumulator(0)

    def send(rows: Iterator) -> None:
        task = TaskContext.get().partitionId()
        batch = 0
        while chunk := [r.asDict(recursive=True) for r in islice(rows, batch_rows)]:
            insert(task, batch, chunk)
            total.add(len(chunk))
            batch += 1

    # Rows of its own, as a caller may hold on to those of `df`.
    rows = df.select("*").rdd
    rows.foreachPartition(send)
    rows.cleanShuffleDependencies()
    return total.value
