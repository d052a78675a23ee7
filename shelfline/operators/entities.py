"""Entity lists: explode, aggregate to marts, number into dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from shelfline.functions.scoring import non_empty, percent_or_zero, total_reviews
from shelfline.functions.text import split_entities
from shelfline.session import run_dir


def explode_entities(
    df: DataFrame, col: str, keep: list[str], mode: str = "loose", unique_input: bool = False,
) -> DataFrame:
    """One distinct row per (kept columns, entity).

    Duplicates inside one list go in the row itself. With `unique_input` the caller states that
    the kept columns identify a row (silver tables do by construction); then nothing is left to
    de-duplicate across rows and the operator needs no shuffle at all.
    """
    names = F.array_distinct(split_entities(F.col(col), mode))
    rows = df.filter(non_empty(F.col(col))).select(*keep, F.explode(names).alias(col))
    return rows if unique_input else rows.distinct()


def explode_kinds(df: DataFrame, kinds: list[str], keep: list[str], kind: str = "kind", name: str = "name",
                  mode: str = "loose") -> DataFrame:
    """`explode_entities` of several list columns in one pass: a row per (kept columns, list column, entity). The kept
    columns must identify a row."""
    def named(col: str):
        names = F.array_distinct(split_entities(F.col(col), mode))
        pairs = F.transform(names, lambda n: F.struct(F.lit(col).alias(kind), n.alias(name)))
        return F.when(non_empty(F.col(col)), pairs).otherwise(F.array().cast(f"array<struct<{kind}:string,{name}:string>>"))

    each = F.explode(F.concat(*[named(c) for c in kinds])).alias("_entity")
    return df.select(*keep, each).select(*keep, "_entity.*")


def entity_mart(
    exploded: DataFrame, entity: str | list[str], id_col: str, pos: str, neg: str, date_col: str,
    unique_input: bool = False,
) -> DataFrame:
    """Entity x date: distinct items, review sums, weighted approval. An entity may be several columns.

    Sums combine map-side, so a prolific entity costs one partial row per task. The exact distinct
    count adds a shuffle on (entity, date, id), which also spreads a hot entity; `unique_input`
    (one row per id, entity and date) makes it a plain count and leaves a single shuffle.
    """
    p, n = F.col(pos).cast("bigint"), F.col(neg).cast("bigint")
    # NULL ids do not count, as in count(distinct).
    items = F.count(id_col) if unique_input else F.countDistinct(id_col)
    keys = [entity] if isinstance(entity, str) else entity
    sums = exploded.groupBy(*keys, date_col).agg(
        items.alias("num_games"),
        F.sum(total_reviews(p, n)).alias("total_reviews"),
        F.sum(p).alias("total_positive"),
        F.sum(n).alias("total_negative"),
    )
    return sums.select(
        *keys, "num_games", "total_reviews", "total_positive", "total_negative",
        percent_or_zero(F.col("total_positive"), F.col("total_reviews")).alias("avg_approval_pct"),
        date_col,
    )


def mart_for_entities(entities: DataFrame, mart: DataFrame, entity: str, date_col: str) -> DataFrame:
    """Left join of an aggregate to its full entity list: entities without items keep null measures.

    Both sides hold one row per (entity, date), so no key can fan out or skew. When the list is
    derived from the same exploded rows the join adds nothing; use `entity_mart` alone then.
    """
    return entities.select(entity, date_col).distinct().join(mart, [entity, date_col], "left")


def entity_dimension(df: DataFrame, entity: str, date_col: str, id_col: str) -> DataFrame:
    """Contiguous 0-based ids per date in name order, without a per-date single-task window.

    The distinct pairs are range-partitioned and sorted by (date, name), so a date that holds most
    of the names still spreads over many tasks. The numbered rows are written to the shared folder
    once: partition bounds are sampled, and ids must not move when a lost executor makes a stage run
    again.
    """
    spark = df.sparkSession
    path = run_dir(spark, f"numbered-{entity}")
    numbered = (
        df.filter(non_empty(F.col(entity)))
        .select(date_col, entity)
        .distinct()
        .repartitionByRange(date_col, entity)
        .sortWithinPartitions(date_col, entity)
        # upper bits: partition, lower 33 bits: position in it
        .withColumn("_pos", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_pos", 33))
    )
    numbered.write.parquet(path)
    ordered = spark.read.schema(numbered.schema).parquet(path)
    # A partition is a contiguous range, so it holds the end of one date, whole dates and the
    # start of another: (partition, date) pairs number at most partitions + dates.
    runs = ordered.groupBy(date_col, "_part").agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    before = Window.partitionBy(date_col).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(
        date_col, "_part", "_first",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"),
    )
    return ordered.join(offsets, [date_col, "_part"]).select(
        (F.col("_pos") - F.col("_first") + F.col("_offset")).alias(id_col), entity, date_col
    )
