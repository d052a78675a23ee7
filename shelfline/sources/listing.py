"""Files of a published folder as a relation, one row a file: no data row is read to find partitions, ages or counts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfline.sources.files import path_exists

FOOTERS = "n_rows long, n_row_groups int"


def list_files(spark: SparkSession, path: str, part: str = "dt", pattern: str = "*.parquet") -> DataFrame:
    """file_path, the partition value, n_bytes and modified_at of every file below a path; none if it doesn't exist.

    Many folders are listed by Spark in parallel. Content is a column that the scan leaves out.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], f"file_path string, `{part}` string, n_bytes bigint, modified_at timestamp")
    files = (
        spark.read.format("binaryFile")
        .schema(f"path string, modificationTime timestamp, length bigint, content binary, `{part}` string")
        .option("pathGlobFilter", pattern)
    )
    return files.load(path).select(
        F.col("path").alias("file_path"), part, F.col("length").alias("n_bytes"), F.col("modificationTime").alias("modified_at"))


def listed_partitions(files: DataFrame, part: str = "dt") -> DataFrame:
    """file_count, total_bytes and modified_at of each partition that has files."""
    return files.filter(F.col(part).isNotNull()).groupBy(part).agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("n_bytes").alias("total_bytes"),
        F.max("modified_at").alias("modified_at"))


def newest_partition(files: DataFrame, part: str = "dt") -> DataFrame:
    """One row with the largest partition value that has a file; reading it fails when there is none."""
    newest = F.max(part)
    return files.agg(F.when(newest.isNotNull(), newest).otherwise(F.raise_error(F.lit("no partitions found"))).alias(part))


def footers(files: DataFrame) -> DataFrame:
    """Adds n_rows and n_row_groups from the footer of each Parquet file; tasks read footers, no data."""
    names = [c for c in files.columns if c not in ("n_rows", "n_row_groups")]
    rows = files.select(*names)
    at = names.index("file_path")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs, parquet

        def metadata(path: str):
            # Hadoop spells local and S3 paths differently
            for prefix, plain in (("file:///", "/"), ("file:/", "/"), ("s3a://", "s3://")):
                if path.startswith(prefix):
                    path = plain + path[len(prefix):]
                    break
            system, inner = (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)
            return parquet.read_metadata(inner, filesystem=system)

        for batch in batches:
            found = [metadata(path) for path in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([m.num_rows for m in found], pa.int64()),
                 pa.array([m.num_row_groups for m in found], pa.int32())],
                [*names, "n_rows", "n_row_groups"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(read, f"{fields}, {FOOTERS}")


def file_stats(files: DataFrame, part: str = "dt") -> DataFrame:
    """file_count, record_count and total_bytes of each partition, from footers."""
    return footers(files).groupBy(part).agg(
        F.count(F.lit(1)).alias("file_count"), F.sum("n_rows").alias("record_count"), F.sum("n_bytes").alias("total_bytes"))
