"""Stored marts and metrics: marts refreshed by date behind gates, metrics computed from the stored marts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from shelfline.plans import catalog
from shelfline.sources.checked import Gate, GateError, Published, not_null, publish_checked
from shelfline.sources.files import drop_folders, latest_partition, list_partitions, partition_folder
from shelfline.sources.tables import read_published

DATE = "partition_date"
#: Mart -> the kind its rows have in the table of entities.
KINDS = {"developers": "developer", "publishers": "publisher"}

GAME_GATES = [
    *not_null("app_id", DATE),
    Gate("reviews are not negative", "coalesce(positive, 0) >= 0 AND coalesce(negative, 0) >= 0"),
]
ENTITY_GATES = [*not_null("name"), Gate("num_games is positive", "num_games > 0")]


@dataclass
class Refreshed:
    games: Published
    entities: Published


def mart_models(staged: DataFrame) -> dict[str, DataFrame]:
    """The marts as computed in one go from staging. Each has partition_date in its grain, so a date can be
    rebuilt on its own."""
    return {
        "games": catalog.games_mart(staged),
        "developers": catalog.entity_model(staged, "developer", unique_input=True),
        "publishers": catalog.entity_model(staged, "publisher", unique_input=True),
    }


def refresh_marts(
    spark: SparkSession, silver_path: str, silver: DataFrame, marts_path: str,
    dates: list[str] | None = None, gone: list[str] | None = None,
) -> Refreshed:
    """Rebuild the marts of the given dates (default all) and drop those of dates gone upstream.

    Incremental use: pass the reloaded and cleared partitions a replication run returned. Only their folders are read, once:
    the games mart takes the newest version of every key, and the entity marts, one table by kind and date, are
    computed from what it stored. A date whose games don't pass the gates keeps its old marts, all of them; the others are
    refreshed, and a GateError at the end names it.
    """
    if dates is None:
        dates = list_partitions(spark, silver_path)
    games = entities = Published(0, [], [])
    if dates:
        rows = read_published(spark, silver_path, silver.schema, dates)
        model = catalog.games_mart(catalog.stage(rows, versioned=True))
        # The date is the partition of silver, so the newest version per key leaves each key once.
        games = publish_checked(
            model, f"{marts_path}/games", [DATE], GAME_GATES, key=["app_id"], replaced=[{DATE: d} for d in dates])
        passed = [d for d in dates if partition_folder(spark, DATE, d) not in games.bad]
        kept = [d for d in passed if partition_folder(spark, DATE, d) in games.good]
        wanted = [{"kind": kind, DATE: d} for kind in KINDS.values() for d in passed]
        stored = read_published(spark, f"{marts_path}/games", model.schema, kept, DATE) if kept else model.limit(0)
        entities = publish_checked(
            catalog.entity_models(stored), f"{marts_path}/entities", ["kind", DATE], ENTITY_GATES, replaced=wanted)
    for date in gone or []:
        folder = partition_folder(spark, DATE, date)
        drop_folders(spark, f"{marts_path}/games/{folder}",
                     *(f"{marts_path}/entities/kind={kind}/{folder}" for kind in KINDS.values()))
    if games.bad or entities.bad:
        raise GateError(f"held back: {games.bad | entities.bad}; failing rows: {games.failures | entities.failures}")
    return Refreshed(games, entities)


def read_mart(spark: SparkSession, marts_path: str, name: str, silver: DataFrame) -> DataFrame:
    schema = mart_models(catalog.stage(silver))[name].schema
    if name not in KINDS:
        return read_published(spark, f"{marts_path}/{name}", schema, part=DATE).select(*schema.names)
    kind = KINDS[name]
    stored = StructType([StructField("name", StringType()) if f.name == kind else f for f in schema.fields])
    rows = read_published(spark, f"{marts_path}/entities/kind={kind}", stored, part=DATE)
    return rows.withColumnRenamed("name", kind).select(*schema.names)


def metric_models(
    spark: SparkSession, marts_path: str, silver: DataFrame, when: str | None = None
) -> dict[str, DataFrame]:
    """Rankings over the stored marts; word counts over staging. `latest` is the newest folder of the games mart."""
    if when == "latest":
        when = latest_partition(spark, f"{marts_path}/games", DATE)
    games, developers, publishers = (
        read_mart(spark, marts_path, name, silver) for name in ("games", "developers", "publishers")
    )
    return {
        "developer_rankings": catalog.entity_rankings(developers, "developer", when=when),
        "publisher_rankings": catalog.entity_rankings(publishers, "publisher", when=when),
        "top_games_ranked": catalog.top_games(games, when=when),
        "worst_games_ranked": catalog.worst_games(games, when=when),
        "game_title_words": catalog.title_words(catalog.stage(silver)),
    }
