"""Partitioned-table scans, partition listings, inspection and introspection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shelfline.sources.files import modified, partition_folder


# Schemas of the test tables, by application, path and its time of change: inferring one is a Spark job of its own.
_schemas: dict[tuple[str, str, int], StructType] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    known = (spark.sparkContext.applicationId, path, modified(spark, path))
    if known not in _schemas:
        _schemas[known] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[known]).parquet(path)


def partitioned_schema(schema: StructType, part: str = "dt") -> StructType:
    """The schema of a published table: `part` last and always a string."""
    fields = [f for f in schema.fields if f.name != part]
    return StructType([*fields, StructField(part, StringType())])


def partition_folders(spark: SparkSession, path: str, values: list[str], part: str = "dt") -> list[str]:
    return [f"{path}/{partition_folder(spark, part, value)}" for value in values]


def read_published(
    spark: SparkSession, path: str, schema: StructType, values: list[str] | None = None,
    part: str = "dt",
) -> DataFrame:
    """A given schema spares the footer pass and keeps dt a string. With `values` only those
    partition folders are listed and read."""
    reader = spark.read.schema(partitioned_schema(schema, part))
    if values is None:
        return reader.parquet(path)
    return reader.option("basePath", path).parquet(*partition_folders(spark, path, values, part))


def scan_glob(
    spark: SparkSession, base: str, pattern: str, schema: StructType, part: str = "dt"
) -> DataFrame:
    """Parquet folders that match a glob, with the partition column of the base path."""
    reader = spark.read.schema(partitioned_schema(schema, part)).option("basePath", base)
    return reader.parquet(f"{base}/{pattern}")


def scan_partitions(
    df: DataFrame, values: list[str] | str | DataFrame, part: str = "dt"
) -> DataFrame:
    """Rows of one partition, of a list, or of the partitions named by a DataFrame.

    A literal list prunes folders at planning time. The DataFrame form is a semi join for lists
    too long for a literal; Spark prunes dynamically where it can.
    """
    if isinstance(values, DataFrame):
        return df.join(values.select(part).distinct(), part, "left_semi")
    wanted = [values] if isinstance(values, str) else list(values)
    return df.filter(F.col(part).isin(wanted))


def partition_list(df: DataFrame, part: str = "dt") -> DataFrame:
    return df.select(part).distinct().filter(F.col(part).isNotNull())


def partition_values(df: DataFrame, part: str = "dt") -> list[str]:
    """Partition values on the driver: as many as the table has partitions, never rows."""
    return sorted(r[0] for r in partition_list(df, part).collect())


def latest_partition_row(df: DataFrame, part: str = "dt") -> DataFrame:
    """One row with the newest partition; reading it fails when there is none."""
    newest = F.max(part)
    checked = F.when(newest.isNotNull(), newest).otherwise(F.raise_error(F.lit("no partitions found")))
    return df.agg(checked.alias(part))


def partition_stats(df: DataFrame, part: str = "dt") -> DataFrame:
    """File count, record count and bytes per partition from file metadata, no data columns read."""
    files = (
        df.select(part, "_metadata.file_path", "_metadata.file_size")
        .groupBy(part, "file_path")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.max("file_size").alias("n_bytes"))
    )
    return files.groupBy(part).agg(
        F.count(F.lit(1)).alias("file_count"),
        F.sum("n_rows").alias("record_count"),
        F.sum("n_bytes").alias("total_bytes"),
    )


def modified_partitions(df: DataFrame, part: str = "dt") -> DataFrame:
    """Newest file modification time per partition."""
    return df.groupBy(part).agg(F.max("_metadata.file_modification_time").alias("modified_at"))


def describe(df: DataFrame) -> DataFrame:
    """Column name, type and non-null count of every column, one pass over the data."""
    names = df.columns
    counts = df.agg(*[F.count(c).alias(c) for c in names]).unpivot([], names, "column_name", "non_null")
    types = F.create_map(*[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())])
    order = F.create_map(*[F.lit(x) for i, c in enumerate(names, 1) for x in (c, i)])
    return counts.select(
        order[F.col("column_name")].cast("bigint").alias("ordinal"),
        "column_name",
        types[F.col("column_name")].alias("data_type"),
        "non_null",
    )


def list_tables(spark: SparkSession, pattern: str = "*") -> DataFrame:
    """SHOW TABLES with what a reader asks next: table_name, is_temporary, n_columns and n_rows of each table
    that the pattern names. Counts of Parquet tables read footers."""
    found = spark.sql(f"SHOW TABLES LIKE '{pattern}'").collect()  # as many as there are tables
    rows = [
        spark.table(f"`{r['namespace']}`.`{r['tableName']}`" if r["namespace"] else f"`{r['tableName']}`") for r in found]
    if not rows:
        return spark.createDataFrame([], "table_name string, is_temporary boolean, n_columns bigint, n_rows bigint")
    counted = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(r["tableName"]).alias("table_name"), F.lit(r["isTemporary"]).alias("is_temporary"),
            F.lit(len(df.columns)).cast("bigint").alias("n_columns"), "n_rows")
        for r, df in zip(found, rows)]
    return reduce(DataFrame.unionByName, counted)


def array_elements(df: DataFrame, col: str, keep: list[str], name: str = "element", place: str = "place") -> DataFrame:
    """Elements of an array column as rows, with their 0-based place; null and empty arrays give none."""
    return df.select(*keep, F.posexplode(col).alias(place, name))


def json_keys(df: DataFrame, col: str) -> DataFrame:
    """Top-level keys of a JSON column with the number of documents that carry them."""
    keys = df.select(F.explode(F.json_object_keys(col)).alias("key"))
    return keys.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"))


def json_entries(df: DataFrame, col: str, keep: list[str]) -> DataFrame:
    """Every key/value pair of a flat JSON object as a row; bad documents give none."""
    entries = F.from_json(col, "map<string,string>")
    return df.select(*keep, F.explode(entries).alias("key", "value"))


def json_elements(
    df: DataFrame, col: str, field: str, element: str, keep: list[str], name: str = "element"
) -> DataFrame:
    """Elements of an array inside a JSON document as rows, parsed with the given element type."""
    parsed = F.from_json(col, f"struct<{field}: array<{element}>>").getField(field)
    return df.select(*keep, F.explode(parsed).alias(name))
