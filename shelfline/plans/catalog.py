"""Catalogue models: staging, marts and metrics, each a function DataFrame -> DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfline.functions.scoring import (
    approval_pct, approval_ratio, cents_to_currency, int_or_zero, minutes_to_hours, non_empty,
    price_bucket, total_reviews, wilson_lower_bound,
)
from shelfline.functions.text import title_case
from shelfline.operators.entities import entity_mart, explode_entities, explode_kinds
from shelfline.operators.latest import latest_by
from shelfline.operators.ranking import as_of, gated_ranking, top_n, top_ranked
from shelfline.operators.tiers import index_to_base, retained, tier_profile
from shelfline.operators.tokens import token_counts

# Silver name -> staging name, in staging order.
STAGING_COLUMNS = {
    "appid": "app_id",
    "game_title": "game_title",
    "developer": "developer",
    "publisher": "publisher",
    "score_rank": "score_rank",
    "owners": "owners",
    "price": "price",
    "initialprice": "initial_price",
    "discount": "discount",
    "run_id": "run_id",
    "positive": "positive",
    "negative": "negative",
    "userscore": "userscore",
    "average_forever": "average_playtime_forever",
    "average_2weeks": "average_playtime_2weeks",
    "median_forever": "median_playtime_forever",
    "median_2weeks": "median_playtime_2weeks",
    "ccu": "ccu",
    "ingestion_timestamp": "ingested_at",
    "dt": "partition_date",
}

GAME_KEY = ["app_id", "partition_date"]


def stage(silver: DataFrame, versioned: bool = False) -> DataFrame:
    """Rename and reorder. `versioned`: the table may hold several versions of a key, keep the
    newest; a table published by partition holds one by construction and needs no shuffle here."""
    if versioned:
        silver = latest_by(silver, ["appid", "dt"], "ingestion_timestamp")
    return silver.select(*[F.col(old).alias(new) for old, new in STAGING_COLUMNS.items()])


def games_mart(staged: DataFrame) -> DataFrame:
    """Staging columns without run_id; review total, approval and Wilson score after the counts."""
    pos, neg = F.col("positive"), F.col("negative")
    scores = [
        total_reviews(pos, neg).alias("total_reviews"),
        approval_pct(pos, neg).alias("approval_pct"),
        wilson_lower_bound(pos, neg).alias("wilson_score"),
    ]
    kept = [c for c in STAGING_COLUMNS.values() if c != "run_id"]
    after = kept.index("negative") + 1
    return staged.select(*kept[:after], *scores, *kept[after:])


def exploded(staged: DataFrame, entity: str, mode: str = "loose", unique_input: bool = False) -> DataFrame:
    keep = ["app_id", "positive", "negative", "partition_date"]
    return explode_entities(staged, entity, keep, mode, unique_input)


def entity_model(staged: DataFrame, entity: str, unique_input: bool = False) -> DataFrame:
    """Developers or publishers mart."""
    rows = exploded(staged, entity, unique_input=unique_input)
    return entity_mart(rows, entity, "app_id", "positive", "negative", "partition_date", unique_input)


def entity_models(games: DataFrame) -> DataFrame:
    """Developers and publishers marts in one pass, told apart by `kind`; rows must be unique by GAME_KEY."""
    rows = explode_kinds(games, ["developer", "publisher"], ["app_id", "positive", "negative", "partition_date"])
    return entity_mart(rows, ["kind", "name"], "app_id", "positive", "negative", "partition_date", unique_input=True)


def entity_rankings(mart: DataFrame, entity: str, n: int = 20, when: str | None = None) -> DataFrame:
    """Top entities by review volume. `when` picks one date of a stored mart; None ranks every
    (entity, date)."""
    reviewed = as_of(mart, "partition_date", when).filter("total_reviews > 0")
    return top_ranked(reviewed, "total_reviews", [entity, "partition_date"], n).select(
        "rank", entity, "num_games", "total_reviews", "total_positive", "total_negative",
        "avg_approval_pct",
    )


def top_games(
    games: DataFrame, pool: int = 500, n: int = 50, when: str | None = None
) -> DataFrame:
    """Best `pool` games by Wilson score, the top `n` of them by positive reviews."""
    reviewed = as_of(games, "partition_date", when).filter("total_reviews > 0")
    ranked = gated_ranking(reviewed, "wilson_score", pool, "positive", n, GAME_KEY)
    return ranked.select(
        "rank", "game_title", "total_reviews", "positive", "negative", "approval_pct", "wilson_score"
    )


def worst_games(games: DataFrame, n: int = 10, when: str | None = None) -> DataFrame:
    reviewed = as_of(games, "partition_date", when).filter("total_reviews > 0")
    return top_ranked(reviewed, "negative", GAME_KEY, n).select(
        "rank", "game_title", "positive", "negative", "total_reviews", "approval_pct"
    )


def title_words(staged: DataFrame, letters_only: bool = False) -> DataFrame:
    return token_counts(staged, "game_title", letters_only=letters_only)


def word_cloud(words: DataFrame, n: int = 200) -> DataFrame:
    return top_n(words, "word_count", ["word"], n)


def chart_order(ranked: DataFrame, columns: list[str], n: int) -> DataFrame:
    """The first n of a ranking, last rank first."""
    first = ranked.orderBy(F.col("rank").asc()).limit(n)
    return first.select("rank", *columns).orderBy(F.col("rank").desc())


# --- owner tiers -------------------------------------------------------------------------------

LADDER = ["avg_price_usd", "avg_approval", "avg_playtime_hrs"]


def tier_ladder(staged: DataFrame) -> DataFrame:
    """Average price, approval %, lifetime and two-week hours per owner tier."""
    metrics = {
        "avg_price_usd": cents_to_currency(int_or_zero(F.col("initial_price"))),
        "avg_approval": approval_ratio(F.col("positive"), F.col("negative")) * 100,
        "avg_playtime_hrs": minutes_to_hours(F.col("average_playtime_forever")),
        "avg_2w_hrs": minutes_to_hours(F.col("average_playtime_2weeks")),
    }
    return tier_profile(staged, "owners", metrics)


def tier_index(ladder: DataFrame) -> DataFrame:
    return index_to_base(ladder, "lo", LADDER)


def tier_retention(ladder: DataFrame, threshold: float = 0.05) -> DataFrame:
    return retained(ladder, "avg_2w_hrs", threshold)


# --- single-game and developer reports ---------------------------------------------------------


def scatter_points(staged: DataFrame, min_reviews: int = 100, max_hours: float = 300.0) -> DataFrame:
    """Hours played against approval, with price band, for games reviewed both ways."""
    pos, neg = F.col("positive"), F.col("negative")
    reviewed = staged.filter(
        (total_reviews(pos, neg) > min_reviews)
        & (F.col("average_playtime_forever") > 0) & (pos > 0) & (neg > 0)
    )
    points = reviewed.select(
        *GAME_KEY,
        minutes_to_hours(F.col("average_playtime_forever")).alias("playtime_hrs"),
        (approval_ratio(pos, neg) * 100).alias("approval"),
        cents_to_currency(int_or_zero(F.col("initial_price"))).alias("price_usd"),
    )
    shown = points.filter(F.col("playtime_hrs") <= max_hours)
    return shown.withColumn("price_band", price_bucket(F.col("price_usd")))


def bubble_size(n: Column, factor: int = 30, smallest: int = 80) -> Column:
    return F.greatest(n * factor, F.lit(smallest))


def dev_power(
    staged: DataFrame, min_games: int = 5, min_reviews: int = 200_000, n: int = 20
) -> DataFrame:
    """Review volume against unweighted approval per developer string (lists not split)."""
    pos, neg = F.col("positive").cast("bigint"), F.col("negative").cast("bigint")
    studios = (
        staged.filter(non_empty(F.col("developer")))
        .groupBy("developer")
        .agg(
            F.count(F.lit(1)).alias("num_games"),
            F.sum(total_reviews(pos, neg)).alias("total_reviews"),
            F.coalesce(F.avg(approval_ratio(pos, neg)) * 100, F.lit(0.0)).alias("avg_approval"),
            F.sum(pos).alias("total_positive"),
            F.sum(neg).alias("total_negative"),
        )
        .filter((F.col("num_games") >= min_games) & (F.col("total_reviews") >= min_reviews))
    )
    return top_ranked(studios, "total_reviews", ["developer"], n).withColumns({
        "display_name": title_case(F.col("developer")),
        "bubble_size": bubble_size(F.col("num_games")),
    })


def fans_vs_critics(power: DataFrame, n: int = 15) -> DataFrame:
    """Diverging pair in millions for the n biggest developers, smallest of them first."""
    million = F.lit(1_000_000.0)
    pair = power.orderBy("rank").limit(n).select(
        "rank", "display_name",
        (F.col("total_positive") / million).alias("positive_m"),
        (-F.col("total_negative") / million).alias("negative_m"),
    )
    return pair.orderBy(F.col("rank").desc())
