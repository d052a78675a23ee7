"""Connected components by alternating large and small stars, on DataFrames only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfline.llm.frames import stored


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, root) for every node that has a link, root the smallest node of its component.

    Null ends and self links are ignored. Minima are aggregated map-side, and the joins that hand them back
    can be split, so a node with a third of all links is no single task. Every round is written to the shared
    folder; rounds grow with the logarithm of the component size.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = stored(edges.filter("u IS NOT NULL AND v IS NOT NULL AND u <> v").distinct(), "links")
    before = _mark(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = moved.filter("u <> v").unionByName(smallest.select("u", F.col("m").alias("v"))).distinct()
        edges = stored(small, "stars")
        now = _mark(edges)
        if now == before:
            break
        before = now
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
