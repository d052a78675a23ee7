"""Merge into a published folder by rewriting only the partitions that hold a key of the updates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from shelfline.operators.latest import latest_by, upsert
from shelfline.session import run_dir
from shelfline.sources.checked import Gate, publish_checked
from shelfline.sources.files import drop_folders, list_partitions, partition_folder
from shelfline.sources.tables import partition_list, partitioned_schema, read_published


@dataclass(frozen=True)
class Merged:
    rewritten: list[str]
    cleared: list[str]
    rows: int


def merge_partitions(
    spark: SparkSession, path: str, schema: StructType, updates: DataFrame, keys: list[str], part: str = "dt",
    version: str | None = None, ties: tuple[str, ...] = (), gates: list[Gate] | None = None,
) -> Merged:
    """Rows of the updates replace those of the same key, wherever they are, or are added; a key may move to another partition.

    Updates are computed once. A scan of the key columns alone finds the partitions that hold their keys; those and the
    partitions of the updates are read whole, merged and swapped in, each by one rename; files of others stay as they are. If
    the partition column is part of the key, a key can't move and the scan is left out. Keys are unique afterwards, or the
    partition is held back with an error. Several updates of a key need `version`; null keys match nothing and are added.
    """
    names = partitioned_schema(schema, part).names
    newest = latest_by(updates, keys, version, ties) if version else updates
    work = run_dir(spark, "updates")
    newest.select(*names).write.parquet(work)
    stored = spark.read.schema(partitioned_schema(schema, part)).parquet(work)
    present = set(list_partitions(spark, path, part))
    affected = partition_list(stored, part)
    if part not in keys and present:
        held = read_published(spark, path, schema, part=part).select(*keys, part)
        affected = affected.unionByName(partition_list(held.join(stored.select(*keys), keys, "left_semi"), part)).distinct()
    # Partition values only.
    touched = sorted(r[0] for r in affected.collect())
    old = [v for v in touched if v in present]
    merged = stored if not old else upsert(read_published(spark, path, schema, old, part).select(*names), stored, keys)
    done = publish_checked(
        merged.select(*names), path, [part], gates or [], key=[k for k in keys if k != part], replaced=[{part: v} for v in touched])
    drop_folders(spark, work)
    done.checked()
    values = lambda folders: [v for v in touched if partition_folder(spark, part, v) in folders]
    return Merged(values(done.good), values(done.cleared), done.rows)
