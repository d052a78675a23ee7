"""Landing to metrics, with an incremental second day."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from shelfline import session
from shelfline.plans import build, catalog
from shelfline.operators.replication import ADDED, replicate
from shelfline.sources.landing import (
    BRONZE_SCHEMA, build_silver, entry_pages, ingest_bronze, silver_rows, write_pages,
)
from shelfline.sources.sinks import PathTarget
from shelfline.sources.tables import partition_list, read_published


def entries(spark, dt, factor):
    return spark.range(300).select(
        F.col("id").cast("int").alias("appid"),
        F.concat(F.lit("Game "), F.col("id").cast("string")).alias("name"),
        # a third of all games belong to one studio
        F.when(F.col("id") % 3 == 0, "Hot Studio, LLC")
        .otherwise(F.concat(F.lit("Studio "), (F.col("id") % 20).cast("string"))).alias("developer"),
        F.lit("Pub A, Pub B").alias("publisher"),
        (F.col("id") * factor).cast("int").alias("positive"),
        F.lit(10).alias("negative"),
        F.lit("0 .. 20,000").alias("owners"),
        F.lit(dt).alias("dt"),
        F.floor(F.col("id") / 100).cast("int").alias("page"),
    )


def test_landing_to_metrics(spark, folder):
    paths = {n: f"{folder}/{n}" for n in ("landing", "bronze", "silver", "serving", "state", "marts")}
    landing = f"{paths['landing']}/request=all"
    log, files = [], []

    def day(dt, factor, snapshot):
        write_pages(entry_pages(entries(spark, dt, factor)), paths["landing"])
        ingest_bronze(spark, landing, paths["bronze"], "src", f"run-{dt}", [dt])
        assert build_silver(spark, paths["bronze"], paths["silver"], [dt]) == 300
        log.append((snapshot, f"2026-02-{len(log) + 1:02d}"))
        files.append((ADDED, snapshot, ((dt,),)))
        snapshots = spark.createDataFrame(log, "snapshot_id bigint, at string").select(
            "snapshot_id", F.to_timestamp("at").alias("committed_at"))
        return replicate(
            spark, lambda _: silver(), PathTarget(spark, paths["serving"]), paths["state"], "games", snapshots,
            spark.createDataFrame(files, "status int, snapshot_id bigint, data_file struct<partition: struct<dt: string>>"),
        )

    def schema():
        return silver_rows(read_published(spark, paths["bronze"], BRONZE_SCHEMA)).schema

    def silver():
        return read_published(spark, paths["silver"], schema())

    def serving():
        return read_published(spark, paths["serving"], schema())

    first = day("2026-01-01", 1, 90)
    assert first.mode == "full"
    build.refresh_marts(spark, paths["serving"], serving(), paths["marts"], first.reloaded, first.cleared)
    second = day("2026-01-02", 2, 10)
    assert (second.mode, second.reloaded) == ("incremental", ["2026-01-02"])
    build.refresh_marts(spark, paths["serving"], serving(), paths["marts"], second.reloaded, second.cleared)

    # incremental marts equal marts computed in one go
    for name, mart in build.mart_models(catalog.stage(serving())).items():
        stored = build.read_mart(spark, paths["marts"], name, serving())
        assert stored.count() == mart.count() and stored.exceptAll(mart).isEmpty()

    metrics = build.metric_models(spark, paths["marts"], serving(), when="latest")
    top = metrics["developer_rankings"].orderBy("rank").first()
    assert (top.developer, top.num_games) == ("hot studio, llc", 100)
    assert top.total_positive == sum(2 * i for i in range(0, 300, 3))
    assert metrics["publisher_rankings"].count() == 2
    assert metrics["worst_games_ranked"].count() == 10
    assert metrics["top_games_ranked"].orderBy("rank").first().game_title == "game 299"
    assert {r.word: r.word_count for r in metrics["game_title_words"].collect()}["game"] == 600
    assert partition_list(build.read_mart(spark, paths["marts"], "games", serving()), "partition_date").count() == 2

    build.refresh_marts(spark, paths["serving"], serving(), paths["marts"], [], ["2026-01-01"])
    assert partition_list(build.read_mart(spark, paths["marts"], "games", serving()), "partition_date").count() == 1


def test_session_settings(spark):
    assert session.SESSION_CONF["spark.sql.session.timeZone"] == "UTC"
    assert "spark.hadoop.fs.s3a.endpoint" in session.s3a_conf("e", "k", "s")
    assert "spark.sql.catalog.lake.uri" in session.iceberg_rest_conf("lake", "u", "w")
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_shared_folder(spark, monkeypatch):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    one, other = session.run_dir(spark, "x"), session.run_dir(spark, "x")
    assert one != other and one.startswith("file:/")

    class Cluster:
        class sparkContext:  # noqa: N801 - stands for a session attribute
            master = "spark://host:7077"

        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Cluster)


def test_work_tables_can_be_removed(tmp_path):
    """In a program of its own, as they are the whole application's."""
    code = f"""
import os, sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from shelfline import session
spark = session.get_spark("elsewhere", master="local[2]", conf={{"spark.ui.enabled": "false"}})
path = session.run_dir(spark, "x")
spark.range(3).write.parquet(path)
assert os.path.exists(path.removeprefix("file:"))
session.clean_runs(spark)
assert not os.path.exists(path.removeprefix("file:"))
"""
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
