"""Exact distinct counts from mergeable states: a bitmap of 256 ids for each bucket of ids.

A state is a set, so a repeated id changes nothing, and states of dates add up to the state of a period without a look at
the rows. Counting rows would need a promise that ids are unique; a plain distinct count can't be rolled up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: A bucket has 1 << BITS ids. A key with few, scattered ids has as many states, so a state must be small.
BITS = 8


def _dealt(df: DataFrame, keys: list[str], bucket: str) -> DataFrame:
    """Rows brought to their key and bucket before they are aggregated. Spark's bitmap aggregates work in 4,096 bytes a
    group; so those are neither shuffled nor sorted, and a hot key is spread over its buckets."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys, bucket)


def _cut(bitmap: Column) -> Column:
    """The bytes that a bucket's ids can set."""
    return F.substring(bitmap, 1, (1 << BITS) // 8)


def distinct_states(df: DataFrame, keys: list[str], id_col: str, bucket: str = "bucket", ids: str = "ids") -> DataFrame:
    """One bitmap per (keys, bucket of whole-number ids). Null ids are in none."""
    known = df.filter(F.col(id_col).isNotNull())
    number = F.col(id_col).cast("bigint")
    placed = known.select(
        *keys, F.shiftright(number, BITS).alias(bucket), number.bitwiseAND((1 << BITS) - 1).alias("_bit"))
    return _dealt(placed, keys, bucket).groupBy(*keys, bucket).agg(_cut(F.bitmap_construct_agg("_bit")).alias(ids))


def merged_states(states: DataFrame, keys: list[str], bucket: str = "bucket", ids: str = "ids") -> DataFrame:
    """States of fewer keys: the union of the bitmaps."""
    placed = _dealt(states.select(*keys, bucket, ids), keys, bucket)
    return placed.groupBy(*keys, bucket).agg(_cut(F.bitmap_or_agg(ids)).alias(ids))


def distinct_counts(states: DataFrame, keys: list[str], out: str, bucket: str = "bucket", ids: str = "ids") -> DataFrame:
    """The number of different ids per key."""
    return merged_states(states, keys, bucket, ids).groupBy(*keys).agg(F.sum(F.bitmap_count(ids)).alias(out))
