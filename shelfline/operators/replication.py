"""Snapshot-driven incremental replication of partitioned tables.

`snapshots(snapshot_id, committed_at, ...)` and `entries(status, snapshot_id, data_file)` have the
shape of Iceberg's metadata tables; feed `t.snapshots` and `t.all_entries` (the plain `entries`
table forgets deletions of older snapshots), or any commit log of that shape.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from shelfline.operators.latest import latest_by
from shelfline.sources.files import drop_folders, list_names, path_exists
from shelfline.sources.listing import list_files, listed_partitions
from shelfline.sources.sinks import PathTarget, TableTarget
from shelfline.sources.tables import partition_list, partition_values, read_published

ADDED, DELETED = 1, 2

STATE_SCHEMA = StructType([
    StructField("table_name", StringType()),
    StructField("last_snapshot_id", LongType()),
    StructField("last_replicated_at", TimestampType()),
    StructField("updated_at", TimestampType()),
])


def newest_id() -> Column:
    """The id committed last. Ids are not ordered in time, so only committed_at counts."""
    return F.max_by("snapshot_id", F.struct("committed_at", "snapshot_id"))


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    """One row: the id committed last; reading it fails when there is none."""
    newest = newest_id()
    found = F.when(newest.isNotNull(), newest).otherwise(F.raise_error(F.lit("no snapshots found")))
    return snapshots.agg(found.alias("snapshot_id"), F.max("committed_at").alias("committed_at"))


def newest_snapshot_id(snapshots: DataFrame) -> int:
    return latest_snapshot(snapshots).collect()[0]["snapshot_id"]


def _commit_time(snapshots: DataFrame, snapshot: int) -> Column:
    return snapshots.filter(F.col("snapshot_id") == snapshot).agg(F.max("committed_at")).scalar()


def changed_partitions(
    snapshots: DataFrame, entries: DataFrame, since: int, until: int | None = None, part: str = "dt"
) -> DataFrame:
    """Distinct partitions with files added or deleted after `since`, up to `until`.

    Snapshots that share the commit time of `since` are included: loading a partition again is
    harmless, missing one is not.
    """
    at = F.col("committed_at")
    newer = (at >= _commit_time(snapshots, since)) & (F.col("snapshot_id") != since)
    if until is not None:
        newer = newer & (at <= _commit_time(snapshots, until))
    wanted = snapshots.filter(newer).select("snapshot_id")
    changed = (
        entries.filter(F.col("status").isin(ADDED, DELETED))
        .join(wanted, "snapshot_id", "left_semi")
        .select(F.col(f"data_file.partition.{part}").alias(part))
    )
    return partition_list(changed, part)


def latest_state(state: DataFrame) -> DataFrame:
    """Newest state row per table."""
    return latest_by(state, ["table_name"], "updated_at", ("last_snapshot_id",))


def read_state(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], STATE_SCHEMA)
    return spark.read.schema(STATE_SCHEMA).parquet(path)


def last_replicated(state: DataFrame, table: str) -> int | None:
    rows = latest_state(state.filter(F.col("table_name") == table)).collect()
    return rows[0]["last_snapshot_id"] if rows else None


#: Files of the state log beyond which it is written anew.
STATE_FILES = 32


def record_state(spark: SparkSession, path: str, table: str, snapshot: int, most: int = STATE_FILES) -> None:
    """Upsert by append: readers take the newest row. One writer at a time; a log of more than `most` files is compacted."""
    now = datetime.now(timezone.utc)
    row = spark.createDataFrame([(table, snapshot, now, now)], STATE_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(path)
    if sum(name.endswith(".parquet") for name in list_names(spark, path)) > most:
        compact_state(spark, path)


def compact_state(spark: SparkSession, path: str) -> None:
    """Leaves one file with the newest row of each table. The new file comes before the old ones go, so a reader
    finds the newest rows at any time, also after a crash in between."""
    old = [name for name in list_names(spark, path) if name.endswith(".parquet")]
    newest = latest_state(spark.read.schema(STATE_SCHEMA).parquet(*old))
    newest.coalesce(1).write.mode("append").parquet(path)
    drop_folders(spark, *old)


@dataclass(frozen=True)
class Plan:
    mode: str  # "full", "none" or "incremental"
    target: int  # the snapshot this run copies and records
    partitions: DataFrame  # the partitions to reload


def replication_plan(
    snapshots: DataFrame, entries: DataFrame, live: DataFrame, last: int | None,
    full_load: bool = False, from_snapshot: int | None = None, target: int | None = None,
    part: str = "dt",
) -> Plan:
    """Decide what to reload to get from the last replicated snapshot to `target` (default newest).

    Only snapshot ids reach the driver. An unknown last id (an expired snapshot) means full load.
    """
    if target is None:
        target = newest_snapshot_id(snapshots)
    since = from_snapshot if from_snapshot is not None else last
    everything = partition_list(live, part)
    if full_load or since is None:
        return Plan("full", target, everything)
    if since == target:
        return Plan("none", target, everything.limit(0))
    if snapshots.filter(F.col("snapshot_id") == since).isEmpty():
        return Plan("full", target, everything)
    return Plan("incremental", target, changed_partitions(snapshots, entries, since, target, part))


@dataclass(frozen=True)
class PathSource:
    """A published folder as the source of `replicate`: its present content, its partitions from a listing."""

    spark: SparkSession
    path: str
    schema: StructType
    part: str = "dt"

    def __call__(self, _: int) -> DataFrame:
        return read_published(self.spark, self.path, self.schema, part=self.part)

    def partitions(self, _: int) -> DataFrame:
        return listed_partitions(list_files(self.spark, self.path, self.part), self.part).select(self.part)


@dataclass(frozen=True)
class Outcome:
    mode: str
    reloaded: list[str]
    cleared: list[str]
    rows: int


def replicate(
    spark: SparkSession, source: Callable[[int], DataFrame], target: PathTarget | TableTarget,
    state_path: str, table: str, snapshots: DataFrame, entries: DataFrame, full_load: bool = False,
    from_snapshot: int | None = None, part: str = "dt",
) -> Outcome:
    """Bring a published table up to the newest source snapshot.

    `source(snapshot_id)` returns the table as of that snapshot (an Iceberg reader passes the id
    on; a plain Parquet source can only return its present content). A source that also has
    `partitions(snapshot_id)`, one row for each, taken from a listing or a log, spares the scans that would find them
    among the rows. Order of effects: replace live partitions and verify them, drop those gone upstream, record
    state. A crash before the last step makes the next run repeat the same work.
    """
    last = last_replicated(read_state(spark, state_path), table)
    # Captured once: a commit that lands during the copy is left to the next run.
    snapshot = newest_snapshot_id(snapshots)
    live = source(snapshot)
    named = source.partitions(snapshot) if hasattr(source, "partitions") else live
    plan = replication_plan(
        snapshots, entries, named, last, full_load, from_snapshot, snapshot, part
    )
    if plan.mode == "none":
        return Outcome("none", [], [], 0)
    # partition values only: bounded by the number of partitions
    affected = partition_values(plan.partitions, part)
    present = target.partitions()
    if plan.mode == "full":
        reload, gone = affected, sorted(present - set(affected))
    else:
        reload = partition_values(named.filter(F.col(part).isin(affected)), part) if affected else []
        gone = sorted((set(affected) - set(reload)) & present)
    # pruned to the reloaded folders
    rows = target.replace(live.filter(F.col(part).isin(reload)), reload) if reload else 0
    target.drop(gone)
    record_state(spark, state_path, table, snapshot)
    return Outcome(plan.mode, reload, gone, rows)


def replicate_tables(jobs: dict[str, Callable[[], Outcome]], tries: int = 2) -> dict[str, Outcome]:
    """Run one job per table in order, retrying each on its own; later tables still run after a
    failure, which is raised at the end."""
    done: dict[str, Outcome] = {}
    failed: dict[str, Exception] = {}
    for table, job in jobs.items():
        for attempt in range(1, tries + 1):
            try:
                done[table] = job()
                failed.pop(table, None)
                break
            except Exception as error:  # noqa: BLE001 - reported below
                failed[table] = error
    if failed:
        raise RuntimeError(f"replication failed for: {sorted(failed)}") from next(iter(failed.values()))
    return done


def partitions_modified_since(modified: DataFrame, since: datetime | None, part: str = "dt") -> DataFrame:
    """Parquet-only change detection: partitions whose newest file is younger than the state.

    It cannot see deleted partitions; compare partition lists for those.
    """
    changed = modified if since is None else modified.filter(F.col("modified_at") > F.lit(since))
    return changed.select(part)
