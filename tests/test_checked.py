"""Gates: what fails stays out, and what was there stays."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from shelfline.plans import build, catalog
from shelfline.sources import checked
from shelfline.sources.checked import Gate, GateError, not_null, publish_checked
from shelfline.sources.files import list_partitions
from shelfline.sources.sinks import publish_partitions
from shelfline.sources.tables import read_published

GATES = [*not_null("id"), Gate("v is small", "v < 100")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, v int, dt string")


def content(spark, folder, like):
    return sorted(tuple(r) for r in read_published(spark, folder, like.schema).collect())


def test_a_bad_partition_leaves_the_old_one(spark, folder):
    old = frame(spark, [(1, 1, "d1"), (2, 2, "d2"), (3, 3, "d3")])
    first = publish_checked(old, folder, ["dt"], GATES, key=["id"]).checked()
    assert (first.rows, first.good, first.bad) == (3, ["dt=d1", "dt=d2", "dt=d3"], {})
    files = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{folder}/dt=d2/*")}
    new = frame(spark, [(1, 5, "d1"), (2, 500, "d2"), (None, 7, "d2"), (8, 8, "d4"), (9, 9, "d5"), (9, 9, "d5")])
    got = publish_checked(new, folder, ["dt"], GATES, key=["id"], replaced=[{"dt": d} for d in ("d1", "d2", "d3")])
    assert got.good == ["dt=d1", "dt=d4"] and got.cleared == ["dt=d3"]
    assert got.bad == {"dt=d2": ["id is not null", "v is small"], "dt=d5": ["id is unique"]}
    assert got.failures == {"id is not null": 1, "v is small": 1}
    assert content(spark, folder, old) == [(1, 5, "d1"), (2, 2, "d2"), (8, 8, "d4")]
    assert {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{folder}/dt=d2/*")} == files
    assert not os.path.exists(f"{folder}/_staged")
    with pytest.raises(GateError, match="v is small"):
        got.checked()


def test_a_checked_write_leaves_no_shuffle_files(spark, folder, shuffle_files):
    rows = frame(spark, [(i, i % 90, f"d{i % 3}") for i in range(6000)]).repartition(4)
    assert publish_checked(rows, folder, ["dt"], GATES, key=["id"]).rows == 6000
    # Those of counts may stay.
    assert not shuffle_files(least=2000)


def test_a_failed_write_leaves_everything(spark, folder):
    old = frame(spark, [(1, 1, "d1"), (2, 2, "d2")])
    publish_checked(old, folder, ["dt"], GATES)
    broken = old.withColumn("v", F.when(F.col("id") == 2, F.raise_error(F.lit("broken row"))).otherwise(9).cast("int"))
    with pytest.raises(Exception, match="broken row"):
        publish_checked(broken, folder, ["dt"], GATES)
    assert content(spark, folder, old) == [(1, 1, "d1"), (2, 2, "d2")]
    # What it left aside is no part of the table and goes with the next publish.
    publish_checked(frame(spark, [(7, 7, "d2")]), folder, ["dt"], GATES)
    assert content(spark, folder, old) == [(1, 1, "d1"), (7, 7, "d2")]


def test_odd_publishes(spark, folder):
    old = frame(spark, [(1, 1, "a:b"), (2, 2, "o'c")])
    publish_checked(old, folder, ["dt"], GATES).checked()
    assert list_partitions(spark, folder) == ["a:b", "o'c"]
    none = publish_checked(old.limit(0), folder, ["dt"], GATES, key=["id"], replaced=[{"dt": "o'c"}])
    assert (none.rows, none.good, none.cleared) == (0, [], ["dt=o%27c"]) and list_partitions(spark, folder) == ["a:b"]
    two = old.withColumn("kind", F.lit("k"))
    publish_checked(two, folder + "-two", ["kind", "dt"], [], replaced=[{"kind": "k", "dt": "x"}, {"kind": "l", "dt": "y"}])
    assert list_partitions(spark, f"{folder}-two/kind=k") == ["a:b", "o'c"]


def test_lost_files_are_noticed(spark, folder, monkeypatch):
    """The files must hold as many rows as were counted; if not, nothing is swapped in."""
    old = frame(spark, [(1, 1, "d1")])
    publish_checked(old, folder, ["dt"], GATES)

    def lossy(target, written, name):
        raise ValueError(f"{name}: wrote {written} rows, found 0")

    monkeypatch.setattr(checked, "verify_written", lossy)
    with pytest.raises(ValueError, match="found 0"):
        publish_checked(frame(spark, [(5, 5, "d1")]), folder, ["dt"], GATES)
    assert content(spark, folder, old) == [(1, 1, "d1")]


@pytest.fixture
def silver(spark):
    # Ids are strings here, so that a null id can be planted; a third of the games belong to one studio.
    rows = [
        (i, f"game {i}", "hot" if i % 3 == 0 else f"studio {i % 5}, llc, hot", "pub a, pub b" if i % 2 else None, 10 * i, i, dt)
        for i in range(60) for dt in ("2026-01-01", "2026-01-02")]
    df = spark.createDataFrame(rows, "appid int, game_title string, developer string, publisher string, positive int, negative int, dt string")
    return df.select(*[
        F.col(c) if c in df.columns else F.lit(1).alias(c) if c != "ingestion_timestamp" else F.current_timestamp().alias(c)
        for c in catalog.STAGING_COLUMNS])


def test_a_refresh_scans_silver_once(spark, folder, silver, monkeypatch):
    publish_partitions(silver, f"{folder}/silver")
    scans, plans = [], []
    read, publish = build.read_published, build.publish_checked
    monkeypatch.setattr(build, "read_published", lambda s, path, *a, **k: scans.append(path) or read(s, path, *a, **k))
    monkeypatch.setattr(build, "publish_checked", lambda df, *a, **k: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or publish(df, *a, **k))
    done = build.refresh_marts(spark, f"{folder}/silver", silver, f"{folder}/marts")
    assert [p.count("silver") for p in scans] == [1, 0]
    games, entities = plans
    assert games.count("FileScan") == 1 and games.count("Window [") == 1
    # Both entity marts come from one scan of the games mart and one exchange.
    assert entities.count("FileScan") == 1 and entities.count("Window") == 0 and entities.count("Exchange hashpartitioning") == 1
    assert len(done.games.good) == 2 and len(done.entities.good) == 4 and done.games.rows == 120
    for name, mart in build.mart_models(catalog.stage(silver)).items():
        stored = build.read_mart(spark, f"{folder}/marts", name, silver)
        assert stored.columns == mart.columns
        left, right = stored.drop("ingested_at"), mart.drop("ingested_at")
        assert left.count() == right.count() and left.exceptAll(right).isEmpty()


def test_a_bad_date_keeps_all_its_marts(spark, folder, silver):
    publish_partitions(silver, f"{folder}/silver")
    marts = f"{folder}/marts"
    build.refresh_marts(spark, f"{folder}/silver", silver, marts)
    before = {n: build.read_mart(spark, marts, n, silver).collect() for n in ("games", "developers", "publishers")}
    worse = silver.withColumns({
        "positive": F.when((F.col("dt") == "2026-01-01") & (F.col("appid") == 7), -1).otherwise(0),
        "developer": F.lit(None).cast("string")})
    publish_partitions(worse, f"{folder}/silver")
    with pytest.raises(GateError, match="2026-01-01.*reviews are not negative"):
        build.refresh_marts(spark, f"{folder}/silver", silver, marts)
    for name, rows in before.items():
        now = build.read_mart(spark, marts, name, silver).collect()
        at = lambda x: sorted(str(r) for r in x if r.partition_date == "2026-01-01")
        assert at(now) == at(rows) and at(rows)
        good = [r for r in now if r.partition_date == "2026-01-02"]
        # The other date was refreshed: no developers any more, no positive reviews.
        assert (name == "developers" and not good) or all(getattr(r, "positive", 0) == 0 and getattr(r, "total_positive", 0) == 0 for r in good)
    build.refresh_marts(spark, f"{folder}/silver", silver, marts, [], ["2026-01-01"])
    assert all(build.read_mart(spark, marts, n, silver).filter("partition_date = '2026-01-01'").isEmpty() for n in ("games", "publishers"))
