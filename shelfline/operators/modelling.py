"""Modelling patterns: flags, pivots, fan-out, history, spine, funnel."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def flag_deleted(df: DataFrame, tombstones: DataFrame, key: str, flag: str = "is_deleted") -> DataFrame:
    """Soft-delete flag: left join to the distinct tombstone keys."""
    marks = tombstones.select(key).distinct().withColumn("_gone", F.lit(True))
    return df.join(marks, key, "left").withColumn(flag, F.col("_gone").isNotNull()).drop("_gone")


def union_sources(sources: dict[str, DataFrame], source_col: str = "source") -> DataFrame:
    """Identically structured sources in one table, each row named after its origin."""
    tagged = [df.withColumn(source_col, F.lit(name)) for name, df in sources.items()]
    return reduce(DataFrame.unionByName, tagged)


def pivot_sum(
    df: DataFrame, keys: list[str], pivot_col: str, values: list[str], amount: str,
    total: str | None = None, scale: int = 2,
) -> DataFrame:
    """Conditional sums in one aggregation pass, one column per listed value."""
    sums = [
        F.round(F.sum(F.when(F.col(pivot_col) == v, F.col(amount)).otherwise(0.0)), scale).alias(
            f"{v.lower()}_amount"
        )
        for v in values
    ]
    if total:
        sums.append(F.round(F.sum(amount), scale).alias(total))
    return df.groupBy(*keys).agg(*sums)


def fan_out(df: DataFrame, quantity: str, unit_col: str = "unit_no") -> DataFrame:
    """One row per unit; rows without a positive quantity vanish."""
    q = F.col(quantity).cast("int")
    return df.filter(q > 0).withColumn(unit_col, F.explode(F.sequence(F.lit(1), q)))


def history(df: DataFrame, key: str, tracked: list[str], date_col: str) -> DataFrame:
    """Type-2 history from dated snapshots: a row per change with its validity range.

    Input grain is (key, date), so a window holds at most one row per snapshot date; no key can
    outgrow that.
    """
    by_date = Window.partitionBy(key).orderBy(date_col)
    state = F.struct(*[F.col(c) for c in tracked])
    first = F.row_number().over(by_date) == 1
    changed = first | ~state.eqNullSafe(F.lag(state).over(by_date))
    changes = df.select(key, *tracked, date_col).withColumn("_changed", changed).filter("_changed")
    valid_to = F.lead(date_col).over(by_date)
    return changes.select(
        key, *tracked,
        F.col(date_col).alias("valid_from"),
        valid_to.alias("valid_to"),
        valid_to.isNull().alias("is_current"),
    )


def funnel(df: DataFrame, who: str, step_col: str, ts: str, steps: list[str]) -> DataFrame:
    """First time of every step, and how many steps were reached in order: a step counts at its first
    time at or after the counted time of the step before. Each step's rows are joined to one row per
    `who`, so no one's events are gathered."""
    firsts = df.groupBy(who).agg(
        *[F.min(F.when(F.col(step_col) == s, F.col(ts))).alias(f"first_{s}") for s in steps]
    )
    reached = df.filter(F.col(step_col) == steps[0]).groupBy(who).agg(F.min(ts).alias("_at"))
    levels = [reached]
    for step in steps[1:]:
        later = df.filter(F.col(step_col) == step).join(levels[-1], who).filter(F.col(ts) >= F.col("_at"))
        levels.append(later.groupBy(who).agg(F.min(ts).alias("_at")))
    hits = reduce(DataFrame.unionByName, [x.select(who) for x in levels])
    depth = hits.groupBy(who).agg(F.count(F.lit(1)).alias("steps_reached"))
    return firsts.join(depth, who, "left").withColumn("steps_reached", F.coalesce("steps_reached", F.lit(0)))


def spine_counts(df: DataFrame, ts: str, day_col: str = "day", margin: int = 0) -> DataFrame:
    """Row count for every calendar day from `margin` days before the first to as many after the last,
    empty days as 0."""
    daily = df.groupBy(F.to_date(ts).alias(day_col)).agg(F.count(F.lit(1)).alias("n_rows"))
    bounds = daily.agg(F.min(day_col).alias("lo"), F.max(day_col).alias("hi"))
    days = bounds.select(F.explode(F.sequence(F.date_sub("lo", margin), F.date_add("hi", margin))).alias(day_col))
    return days.join(daily, day_col, "left").select(
        day_col, F.coalesce("n_rows", F.lit(0)).alias("n_rows")
    )
