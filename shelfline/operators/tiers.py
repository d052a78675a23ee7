"""Tier profiles: averages per encoded range, indexed to the lowest tier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfline.functions.scoring import non_empty, range_high, range_label, range_low


def tier_profile(df: DataFrame, tier_col: str, metrics: dict[str, Column]) -> DataFrame:
    """One row per tier with the average of every metric, 0 where a tier has no value."""
    averages = [F.avg(value).alias(name) for name, value in metrics.items()]
    profile = df.filter(non_empty(F.col(tier_col))).groupBy(tier_col).agg(*averages)
    tier = F.col(tier_col)
    return profile.select(
        tier,
        range_low(tier).alias("lo"),
        range_high(tier).alias("hi"),
        range_label(tier).alias("label"),
        *[F.coalesce(F.col(name), F.lit(0.0)).alias(name) for name in metrics],
    )


def index_to_base(profile: DataFrame, order_col: str, metrics: list[str]) -> DataFrame:
    """Each metric over its value in the lowest tier; a base of 0 or null counts as 1.

    The base is a one-row scalar subquery: no cross join, no collect.
    """
    base = profile.agg(
        F.min_by(F.struct(*[F.col(m) for m in metrics]), F.col(order_col)).alias("base")
    ).scalar()
    indexed = [
        (F.col(m) / F.coalesce(F.nullif(base.getField(m), F.lit(0.0)), F.lit(1.0))).alias(f"{m}_idx")
        for m in metrics
    ]
    return profile.select("*", *indexed)


def retained(profile: DataFrame, recent_col: str, threshold: float = 0.05) -> DataFrame:
    """Tiers whose recent average is meaningfully above zero."""
    return profile.filter(F.col(recent_col) > threshold)
