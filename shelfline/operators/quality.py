"""Data tests: each returns its failures (or failure counts) as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """column_name, failing_rows for all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "failing_rows")


def unique_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def relationship(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent.

    Orphans are sought per distinct key, so a hot child key is one row in the join; only the keys
    found orphaned meet the child rows again.
    """
    keys = child.select(child_key).filter(F.col(child_key).isNotNull()).distinct()
    parents = parent.select(F.col(parent_key).alias(child_key))
    orphans = keys.join(parents, child_key, "left_anti")
    return child.join(orphans, child_key, "left_semi")


def page_report(bronze: DataFrame, part: str = "dt") -> DataFrame:
    """Landing completeness per partition: pages must run 0..max without gaps or repeats."""
    pages = bronze.groupBy(part).agg(
        F.min("page").cast("bigint").alias("first_page"),
        F.max("page").cast("bigint").alias("last_page"),
        F.countDistinct("page").alias("n_pages"),
        F.count(F.lit(1)).alias("n_files"),
    )
    complete = (
        (F.col("first_page") == 0)
        & (F.col("n_pages") == F.col("last_page") + 1)
        & (F.col("n_files") == F.col("n_pages"))
    )
    return pages.withColumn("is_complete", complete)


def page_gaps(bronze: DataFrame, part: str = "dt") -> DataFrame:
    """Only the partitions that must not be processed."""
    return page_report(bronze, part).filter(~F.col("is_complete"))
