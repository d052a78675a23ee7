"""Small DataFrame helpers of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from shelfline.session import run_dir

#: The words of the contracts: runs of anything but ASCII white space.
NOT_WORD = r"[ \x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once a row, also where the body uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names with as many underscores before them as it takes to differ from every column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name in taken:
            name = "_" + name
        out.append(name)
    return out


def words_of(text: str | Column) -> Column:
    """The words of a text as an array; null has none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.coalesce(text, F.lit("")), NOT_WORD), lambda w: w != "")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes an intermediate table to the shared folder and reads it back: lineage ends here, and the
    loss of an executor costs no recomputation."""
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(_plain(df.schema)).parquet(path)


def _plain(schema: StructType) -> StructType:
    return StructType.fromJson(schema.jsonValue())


def running_total(df: DataFrame, keys: list[str], chunk: Column, order: list[Column], value: str, out: str) -> DataFrame:
    """Adds the sum of `value` over earlier rows of the same key, in order of (chunk, order).

    Two levels keep a key with a third of all rows out of one task: totals by (key, chunk) are summed over
    the chunks of a key, and only the rows of one chunk are put in order together.
    """
    rows = df.withColumn("_chunk", chunk)
    totals = rows.groupBy(*keys, "_chunk").agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(*keys, "_chunk", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_base"))
    within = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("_local", F.coalesce(F.sum(value).over(within), F.lit(0)))
    same = [local[k].eqNullSafe(bases[k]) for k in [*keys, "_chunk"]]
    joined = local.join(bases, same)
    return joined.select(*[local[c] for c in df.columns], (F.col("_base") + F.col("_local")).alias(out))
