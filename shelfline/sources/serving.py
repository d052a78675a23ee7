"""Serving tables bucketed by key, so that reading the newest version of every key needs no exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfline.operators.latest import latest_by

BUCKETS = 64


def append_bucketed(
    df: DataFrame, table: str, keys: list[str], buckets: int = BUCKETS, sort_by: list[str] | None = None,
    location: str | None = None,
) -> None:
    """Add a load to a table bucketed by key, created by the first load.

    Rows go to their bucket in one exchange, so a load adds one file to each bucket. All versions of a key lie in one bucket: choose
    keys with a bounded number of versions, and buckets so that one fits a task.
    """
    writer = df.repartition(buckets, *keys).write.mode("append").format("parquet").bucketBy(buckets, *keys)
    writer = writer.sortBy(*(sort_by or keys))
    (writer.option("path", location) if location else writer).saveAsTable(table)


def newest_versions(
    spark: SparkSession, table: str, keys: list[str], version: str, ties: tuple[str, ...] = ()
) -> DataFrame:
    """One row per key, its newest version. The scan reads bucket by bucket, which is the distribution the window needs."""
    return latest_by(spark.table(table), keys, version, ties)
