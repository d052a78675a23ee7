"""Top-k and gated rankings. Limit first, number the few survivors after."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def _order(by: str, ties: list[str], ascending: bool = False) -> list[Column]:
    head = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    return [head, *[F.col(t).asc_nulls_last() for t in ties]]


# Groups that the rows of all tasks are reduced in before the last task.
SPREAD = 256


def top_n(df: DataFrame, by: str, ties: list[str], n: int, ascending: bool = False) -> DataFrame:
    """The n first rows in order. Every task keeps n rows of its own, SPREAD groups of tasks keep n
    each, and the last task sees at most SPREAD x n rows, however many tasks the scan has.

    The per-task step is Spark's window group limit, which session.py sets to reach n = 10,000.
    """
    order = _order(by, ties, ascending)
    dealt = df.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(SPREAD)))
    window = Window.partitionBy("_group").orderBy(*order)
    first = dealt.withColumn("_place", F.row_number().over(window)).filter(F.col("_place") <= n)
    return first.drop("_group", "_place").orderBy(*order).limit(n)


def top_ranked(
    df: DataFrame, by: str, ties: list[str], n: int, rank_col: str = "rank", ascending: bool = False
) -> DataFrame:
    """Top n with their 1-based position. The un-partitioned window sees at most n rows."""
    window = Window.orderBy(*_order(by, ties, ascending))
    ranked = top_n(df, by, ties, n, ascending)
    return ranked.withColumn(rank_col, F.row_number().over(window).cast("bigint"))


def gated_ranking(
    df: DataFrame, gate_by: str, gate_n: int, rank_by: str, n: int, ties: list[str],
    rank_col: str = "rank",
) -> DataFrame:
    """The best `gate_n` rows by one measure form a pool, its best n by another are ranked."""
    pool = top_n(df, gate_by, ties, gate_n)
    return top_ranked(pool, rank_by, ties, n, rank_col)


def as_of(df: DataFrame, date_col: str, when: str | None) -> DataFrame:
    """One date, the newest date (`"latest"`), or every date (None)."""
    if when is None:
        return df
    if when == "latest":
        newest = df.agg(F.max(date_col)).scalar()
        return df.filter(F.col(date_col) == newest)
    return df.filter(F.col(date_col) == when)
