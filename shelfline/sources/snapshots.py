"""Reading a table by a commit log that another system keeps: lineage, live files, time travel, changes.

`snapshots(snapshot_id, parent_id, committed_at, operation)` and
`entries(status, snapshot_id, data_file(file_path, partition, record_count, file_size_in_bytes))` have the shape of the
metadata tables `snapshots` and `all_entries`. The log is only read; nothing here writes one.

Snapshots, like files, are few beside rows. What reaches the driver is the list of files to read, which any scan
of files needs there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from shelfline.operators.replication import ADDED, DELETED, newest_id
from shelfline.sources.tables import partitioned_schema

EXISTING = 0

LINEAGE = """
WITH RECURSIVE line(snapshot_id, parent_id, committed_at, steps) MAX RECURSION LEVEL %d AS (
  SELECT snapshot_id, parent_id, committed_at, 0 FROM {snapshots} WHERE snapshot_id = %d
  UNION ALL
  SELECT s.snapshot_id, s.parent_id, s.committed_at, steps + 1 FROM line JOIN {snapshots} s ON s.snapshot_id = line.parent_id
)
SELECT * FROM line
"""


def lineage(snapshots: DataFrame, tip: int | None = None) -> DataFrame:
    """A snapshot (default the one committed last) and its ancestors, with `steps`, their distance from it.

    Parents that the log no longer holds end the line. A log whose parents form a circle fails, as does an unknown `tip`.
    """
    known = F.max(F.col("snapshot_id") == tip) if tip is not None else F.lit(True)
    log = snapshots.agg(F.count(F.lit(1)).alias("n"), known.alias("known"), newest_id().alias("newest")).first()
    if not log["n"]:
        raise ValueError("no snapshots found")
    if not log["known"]:
        raise ValueError(f"the log has no snapshot {tip}")
    tip = log["newest"] if tip is None else tip
    # A line is no longer than the log, so a deeper recursion is a circle.
    levels = log["n"] + 1
    return snapshots.sparkSession.sql(LINEAGE % (levels, tip), snapshots=snapshots)


def history(snapshots: DataFrame, tip: int | None = None) -> DataFrame:
    """made_current_at, snapshot_id, parent_id and is_current_ancestor of every snapshot: those of abandoned branches aren't
    ancestors of the current one."""
    line = lineage(snapshots, tip).select("snapshot_id", F.lit(True).alias("_line"))
    return snapshots.join(line, "snapshot_id", "left").select(
        F.col("committed_at").alias("made_current_at"), "snapshot_id", "parent_id",
        F.col("_line").isNotNull().alias("is_current_ancestor"))


def _on_line(snapshots: DataFrame, entries: DataFrame, tip: int | None) -> DataFrame:
    """Entries of a snapshot and its ancestors, flat, with the distance of their snapshot."""
    line = lineage(snapshots, tip).select("snapshot_id", "steps")
    return entries.join(line, "snapshot_id").select(
        "snapshot_id", "steps", "status", F.col("data_file.file_path").alias("file_path"), "data_file")


def _last(status_from: int = 0):
    """Of a file's entries that are `status_from` steps or more away, the nearest; a file that a snapshot both deletes and adds is there."""
    own = F.col("steps") >= status_from
    order = F.struct(-F.col("steps"), F.col("status") != DELETED)
    return F.max_by(F.when(own, F.struct("status", "snapshot_id", "data_file")), F.when(own, order))


def live_files(snapshots: DataFrame, entries: DataFrame, at: int | None = None, part: str = "dt") -> DataFrame:
    """The files that make up the table as of a snapshot: file_path, partition value, added_by, record_count, n_bytes.

    Entries are folded along the snapshot's line, the last of each file counts. One aggregate over the log, by file.
    """
    # Manifests rewritten later list a file as existing; it was added by the snapshot that says so.
    added = F.col("status") == ADDED
    last = _on_line(snapshots, entries, at).groupBy("file_path").agg(
        _last().alias("last"), F.max_by(F.when(added, F.col("snapshot_id")), F.when(added, -F.col("steps"))).alias("added_by"))
    return last.filter(F.col("last.status") != DELETED).select(
        "file_path", F.col(f"last.data_file.partition.{part}").alias(part), F.coalesce("added_by", F.col("last.snapshot_id")).alias("added_by"),
        F.col("last.data_file.record_count").alias("record_count"),
        F.col("last.data_file.file_size_in_bytes").alias("n_bytes"))


def changed_files(snapshots: DataFrame, entries: DataFrame, start: int, end: int | None = None, part: str = "dt") -> DataFrame:
    """Files that are live at one of two snapshots only: file_path, partition value and change, `added` or `removed`.

    `start` must be `end` or an ancestor of it: between branches there is no "since". What came and went in between isn't listed.
    """
    line = lineage(snapshots, end).filter(F.col("snapshot_id") == start).select("steps").collect()
    if not line:
        raise ValueError(f"{start} is no ancestor of {end}")
    folded = _on_line(snapshots, entries, end).groupBy("file_path").agg(
        _last().alias("now"), _last(line[0]["steps"]).alias("before"))
    live = lambda c: F.coalesce(F.col(f"{c}.status") != DELETED, F.lit(False))
    change = F.when(live("now") & ~live("before"), "added").when(live("before") & ~live("now"), "removed")
    return folded.select(
        "file_path", F.coalesce(F.col(f"now.data_file.partition.{part}"), F.col(f"before.data_file.partition.{part}")).alias(part),
        change.alias("change")).filter("change IS NOT NULL")


def read_files(
    spark: SparkSession, files: DataFrame, base: str, schema: StructType, part: str = "dt"
) -> DataFrame:
    """Rows of exactly the named files of a table below `base`; no folder is listed."""
    paths = sorted(r["file_path"] for r in files.select("file_path").collect())
    full = partitioned_schema(schema, part)
    if not paths:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", base).parquet(*paths).select(*full.names)


def read_as_of(
    spark: SparkSession, snapshots: DataFrame, entries: DataFrame, base: str, schema: StructType, at: int | None = None,
    part: str = "dt",
) -> DataFrame:
    """The table as of a snapshot."""
    return read_files(spark, live_files(snapshots, entries, at, part), base, schema, part)


def read_between(
    spark: SparkSession, snapshots: DataFrame, entries: DataFrame, base: str, schema: StructType, start: int,
    end: int | None = None, part: str = "dt",
) -> DataFrame:
    """Rows of the files that changed from one snapshot to a later one, with `change`. A partition that was overwritten
    gives its old rows as removed and its new ones as added."""
    files = changed_files(snapshots, entries, start, end, part).persist()
    try:
        added, removed = (
            read_files(spark, files.filter(F.col("change") == c), base, schema, part).withColumn("change", F.lit(c))
            for c in ("added", "removed"))
    finally:
        files.unpersist()
    return added.unionByName(removed)


@dataclass(frozen=True)
class LogSource:
    """A table with a commit log as the source of `replicate`: read as of a snapshot, its partitions taken from the log."""

    spark: SparkSession
    base: str
    schema: StructType
    snapshots: DataFrame
    entries: DataFrame
    part: str = "dt"

    def __call__(self, snapshot: int) -> DataFrame:
        return read_as_of(self.spark, self.snapshots, self.entries, self.base, self.schema, snapshot, self.part)

    def partitions(self, snapshot: int) -> DataFrame:
        live = live_files(self.snapshots, self.entries, snapshot, self.part)
        return live.select(self.part).filter(F.col(self.part).isNotNull()).distinct()
