"""Paged JSON landing files -> bronze (a row per file) -> silver (typed, one row per id and date)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    DateType, IntegerType, MapType, StringType, StructField, StructType, TimestampType,
)

from shelfline.operators.latest import latest_by
from shelfline.operators.quality import page_gaps
from shelfline.sources.files import list_partitions
from shelfline.sources.sinks import (
    PageFiles, publish_partitions, verify_written, write_in_batches,
)
from shelfline.sources.tables import partition_folders, read_published

PAGE_PATTERN = r"page=(\d+)\.json"

#: Pages in a row group of bronze: what a reader has in memory at once.
GROUP_PAGES = 32
#: Codec of bronze, raw text for the most part.
BRONZE_CODEC = "zstd"

# The fields of one catalogue entry.
ENTRY_SCHEMA = StructType([
    StructField("appid", IntegerType()),
    StructField("name", StringType()),
    StructField("developer", StringType()),
    StructField("publisher", StringType()),
    StructField("score_rank", StringType()),
    StructField("positive", IntegerType()),
    StructField("negative", IntegerType()),
    StructField("userscore", IntegerType()),
    StructField("owners", StringType()),
    StructField("average_forever", IntegerType()),
    StructField("average_2weeks", IntegerType()),
    StructField("median_forever", IntegerType()),
    StructField("median_2weeks", IntegerType()),
    StructField("ccu", IntegerType()),
    StructField("price", StringType()),
    StructField("initialprice", StringType()),
    StructField("discount", StringType()),
])


def read_landing(spark: SparkSession, path: str, dates: list[str] | None = None) -> DataFrame:
    """payload, source_file, dt: one row per page file, plain or .gz. With `dates` only their folders are listed."""
    return (
        spark.read.format("text")
        .schema("value string, dt string")
        .option("wholetext", True)
        .option("basePath", path)
        .load(path if dates is None else partition_folders(spark, path, dates))
        .select(F.col("value").alias("payload"), F.col("_metadata.file_path").alias("source_file"), "dt")
    )


def bronze_rows(pages: DataFrame, source: str, run_id: str) -> DataFrame:
    """Lineage columns around the raw text; a file name without a page number is an error."""
    number = F.regexp_extract("source_file", PAGE_PATTERN, 1)
    no_page = F.raise_error(F.concat(F.lit("no page number in: "), F.col("source_file")))
    return pages.select(
        "payload",
        F.current_timestamp().alias("ingestion_timestamp"),
        F.current_date().alias("ingestion_date"),
        F.lit(source).alias("source"),
        F.lit(run_id).alias("run_id"),
        F.when(number != "", number.cast("int")).otherwise(no_page).alias("page"),
        "source_file",
        "dt",
    )


def parse_entries(
    bronze: DataFrame, schema: StructType = ENTRY_SCHEMA, key: str = "appid"
) -> DataFrame:
    """One row per JSON entry. Broken documents and null entries give no row, broken fields null."""
    entries = F.from_json("payload", MapType(StringType(), schema))
    exploded = bronze.select(
        F.explode(entries).alias("_key", "entry"),
        "run_id", "ingestion_timestamp", "page", "source_file", "dt",
    )
    return exploded.filter(F.col(f"entry.{key}").isNotNull()).select(
        "entry.*", "run_id", "ingestion_timestamp", "page", "source_file", "dt"
    )


def silver_rows(bronze: DataFrame, key: str = "appid") -> DataFrame:
    """Newest entry per (key, date); within one run the highest page wins. Names lower-cased."""
    newest = latest_by(
        parse_entries(bronze, ENTRY_SCHEMA, key), [key, "dt"], "ingestion_timestamp",
        ("page", "source_file"),
    )
    lowered = {"name": "game_title", "developer": "developer", "publisher": "publisher"}
    fields = [
        F.lower(f.name).alias(lowered[f.name]) if f.name in lowered else F.col(f.name)
        for f in ENTRY_SCHEMA.fields
    ]
    return newest.select(*fields, "run_id", "ingestion_timestamp", "dt")


BRONZE_SCHEMA = StructType([
    StructField("payload", StringType()),
    StructField("ingestion_timestamp", TimestampType()),
    StructField("ingestion_date", DateType()),
    StructField("source", StringType()),
    StructField("run_id", StringType()),
    StructField("page", IntegerType()),
    StructField("source_file", StringType()),
    StructField("dt", StringType()),
])


def ingest_bronze(
    spark: SparkSession, landing: str, bronze: str, source: str, run_id: str,
    dates: list[str] | None = None,
) -> int:
    """Landing files of the given dates (default all) -> bronze partitions, counted after the write."""
    if dates is None:
        dates = list_partitions(spark, landing)
    pages = read_landing(spark, landing, dates)
    written = publish_partitions(
        bronze_rows(pages, source, run_id), bronze, replaced=dates, group_rows=GROUP_PAGES, codec=BRONZE_CODEC)
    verify_written(read_published(spark, bronze, BRONZE_SCHEMA, dates), written, bronze)
    return written


def build_silver(
    spark: SparkSession, bronze: str, silver: str, dates: list[str] | None = None,
    require_complete: bool = True,
) -> int:
    """Bronze partitions -> silver partitions. A date with missing or repeated pages is an error."""
    if dates is None:
        dates = list_partitions(spark, bronze)
    rows = read_published(spark, bronze, BRONZE_SCHEMA, dates)
    if require_complete:
        gaps = sorted(r["dt"] for r in page_gaps(rows).select("dt").distinct().collect())
        if gaps:
            raise ValueError(f"incomplete landing dates: {gaps}")
    out = silver_rows(rows)
    # A date that parses to nothing loses its old rows.
    written = publish_partitions(out, silver, sort_by="appid", replaced=dates)
    verify_written(read_published(spark, silver, out.schema, dates), written, silver)
    return written


def entry_pages(
    entries: DataFrame, page: str = "page", key: str = "appid", part: str = "dt"
) -> DataFrame:
    """(dt, page, payload): one JSON object per page, keyed by id. Page size bounds each group."""
    fields = [c for c in entries.columns if c not in (page, part)]
    pair = F.concat(F.lit('"'), F.col(key).cast("string"), F.lit('":'), F.to_json(F.struct(*fields)))
    body = F.concat_ws(",", F.collect_list(pair))
    return entries.groupBy(part, page).agg(F.concat(F.lit("{"), body, F.lit("}")).alias("payload"))


def write_pages(pages: DataFrame, path: str, request: str = "all", zipped: bool = False) -> int:
    """Write page documents in the landing layout; returns the number of files."""
    return write_in_batches(pages, PageFiles(path, request, zipped), batch_rows=16)
