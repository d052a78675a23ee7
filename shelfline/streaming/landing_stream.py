"""Landing files picked up as they arrive; every run ends when the backlog is done."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfline.sources.landing import ingest_bronze
from shelfline.sources.tables import partition_values


def ingest_new_pages(
    spark: SparkSession, landing: str, bronze: str, checkpoint: str, source: str, run_id: str
) -> None:
    """Re-publish the bronze partitions of every date that received new files.

    The stream only says which dates changed. A date is then read whole, because replacing its
    partition with the new pages alone would lose the earlier ones. Replays are idempotent.
    """
    # binaryFile reads no content unless it is selected
    new_files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary, dt string")
        .load(landing)
        .select("dt")
    )

    def reload_dates(batch: DataFrame, _: int) -> None:
        dates = partition_values(batch)
        if dates:
            ingest_bronze(spark, landing, bronze, source, run_id, dates)

    query = (
        new_files.writeStream.foreachBatch(reload_dates)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
