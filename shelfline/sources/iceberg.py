"""Iceberg tables as replication sources. Needs the Iceberg runtime on the cluster and a catalog
registered with `session.iceberg_rest_conf`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def commit_log(spark: SparkSession, table: str) -> tuple[DataFrame, DataFrame]:
    """(snapshots, entries) as the replication operators read them."""
    return spark.table(f"{table}.snapshots"), spark.table(f"{table}.all_entries")


def as_of_snapshot(spark: SparkSession, table: str) -> Callable[[int], DataFrame]:
    """Time travel: the source argument of `replicate`."""
    return lambda snapshot: spark.read.option("snapshot-id", snapshot).table(table)


def appended_between(spark: SparkSession, table: str, start: int, end: int) -> DataFrame:
    """Rows appended after `start` up to `end`. Append snapshots only: overwritten partitions are
    found with `changed_partitions` instead."""
    reader = spark.read.format("iceberg")
    return reader.option("start-snapshot-id", start).option("end-snapshot-id", end).load(table)
