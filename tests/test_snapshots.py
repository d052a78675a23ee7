"""Commit logs: lineage, live files, time travel and changes, against a plain walk along the parents."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from shelfline.operators import replication as rep
from shelfline.sources import listing, snapshots
from shelfline.sources.sinks import PathTarget, publish_partitions
from shelfline.sources.tables import read_published

START = datetime(2026, 1, 1)
FILE = "struct<file_path: string, partition: struct<dt: string>, record_count: bigint, file_size_in_bytes: bigint>"


def frames(spark, commits, entries):
    log = spark.createDataFrame(
        [(i, parent, START + timedelta(hours=h), "append") for h, (i, parent) in enumerate(commits)],
        "snapshot_id bigint, parent_id bigint, committed_at timestamp, operation string")
    rows = [(status, i, (f, (f[:2],), 1, 10)) for status, i, f in entries]
    return log, spark.createDataFrame(rows, f"status int, snapshot_id bigint, data_file {FILE}")


def plain_line(commits, tip):
    parents, line = dict(commits), []
    while tip in parents:
        line.append(tip)
        tip = parents[tip]
    return line


def plain_live(commits, entries, tip):
    live = {}
    for snapshot in reversed(plain_line(commits, tip)):
        own = [(s, f) for s, i, f in entries if i == snapshot]
        for status, f in sorted(own, key=lambda x: x[0] != rep.DELETED):  # what a snapshot deletes and adds is there
            if status == rep.DELETED:
                live.pop(f, None)
            else:
                live.setdefault(f, snapshot)
    return live


@pytest.mark.parametrize("seed", [1, 2])
def test_random_logs(spark, seed):
    """Branches, rollbacks, deletions and files that come back."""
    rng = random.Random(seed)
    commits, entries = [(500, None)], [(rep.ADDED, 500, "d0-0")]
    for step in range(1, 16):
        parent = commits[-1][0] if rng.random() < 0.8 else rng.choice(commits)[0]
        snapshot = rng.randrange(10**9)
        live = list(plain_live(commits, entries, parent))
        commits.append((snapshot, parent))
        for _ in range(rng.randrange(3)):
            entries.append((rep.ADDED, snapshot, f"d{rng.randrange(4)}-{rng.randrange(30)}"))
        if live and rng.random() < 0.5:
            entries.append((rep.DELETED, snapshot, rng.choice(live)))
        if live and rng.random() < 0.3:
            entries.append((snapshots.EXISTING, snapshot, rng.choice(live)))
    log, all_entries = frames(spark, commits, entries)
    tip = commits[-1][0]
    line = plain_line(commits, tip)
    got = {r.snapshot_id: r.is_current_ancestor for r in snapshots.history(log).collect()}
    assert got == {i: i in line for i, _ in commits}
    assert [r.snapshot_id for r in snapshots.lineage(log).orderBy("steps").collect()] == line
    for at in rng.sample([i for i, _ in commits], 2):
        rows = snapshots.live_files(log, all_entries, at).collect()
        assert {r.file_path for r in rows} == set(plain_live(commits, entries, at))
        assert all(r.dt == r.file_path[:2] and r.record_count == 1 for r in rows)
    start = line[len(line) // 2]
    then, now = set(plain_live(commits, entries, start)), set(plain_live(commits, entries, tip))
    changed = {(r.file_path, r.change) for r in snapshots.changed_files(log, all_entries, start).collect()}
    assert changed == {(f, "added") for f in now - then} | {(f, "removed") for f in then - now}


def test_odd_logs(spark):
    log, entries = frames(spark, [(7, 3), (9, 7), (8, 3)], [(rep.ADDED, 7, "d1-a"), (rep.ADDED, 8, "d2-b"), (rep.ADDED, 99, "d3-c")])
    # An expired parent ends the line; entries of snapshots that the log doesn't hold count for none.
    assert {r.snapshot_id for r in snapshots.lineage(log, 9).collect()} == {9, 7}
    assert [r.file_path for r in snapshots.live_files(log, entries, 9).collect()] == ["d1-a"]
    with pytest.raises(ValueError, match="no snapshot 5"):
        snapshots.lineage(log, 5)
    with pytest.raises(ValueError, match="8 is no ancestor of 9"):
        snapshots.changed_files(log, entries, 8, 9)
    assert snapshots.changed_files(log, entries, 9, 9).count() == 0
    circle, _ = frames(spark, [(1, 2), (2, 1)], [(rep.ADDED, 1, "d1-a")])
    with pytest.raises(Exception, match="RECURSION"):
        snapshots.lineage(circle, 1).collect()
    with pytest.raises(Exception, match="no snapshots found"):
        snapshots.lineage(log.limit(0))


def test_long_lines(spark):
    """More ancestors than a recursion has levels by default."""
    log, _ = frames(spark, [(i, i - 1 or None) for i in range(1, 121)], [(rep.ADDED, 1, "d1-a")])
    assert snapshots.lineage(log).count() == 120


@pytest.fixture
def kept(spark, folder):
    """Files of three commits: two dates, a rewrite of the first and a file that no live snapshot has."""
    rows = lambda *x: spark.createDataFrame(list(x), "id int, dt string")
    written = {}
    for commit, df in {
        1: rows((1, "d1"), (2, "d1"), (3, "d2")), 2: rows((1, "d1")), 3: rows((9, "d3")), 4: rows((7, "d2")),
    }.items():
        df.coalesce(1).write.partitionBy("dt").parquet(f"{folder}/commit={commit}")
        written[commit] = {r.dt: r.file_path for r in listing.list_files(spark, f"{folder}/commit={commit}").collect()}
    log, _ = frames(spark, [(1, None), (2, 1), (4, 1), (3, 2)], [(1, 1, "x")])
    entries = [(rep.ADDED, i, (f, (dt,), 0, 0)) for i, files in written.items() for dt, f in files.items()]
    entries.append((rep.DELETED, 2, (written[1]["d1"], ("d1",), 0, 0)))
    return folder, log, spark.createDataFrame(entries, f"status int, snapshot_id bigint, data_file {FILE}"), written


def test_reads_exactly_the_live_files(spark, kept):
    folder, log, entries, written = kept
    schema = spark.createDataFrame([], "id int, dt string").schema
    read = lambda at: snapshots.read_as_of(spark, log, entries, folder, schema, at)
    assert sorted(tuple(r) for r in read(1).collect()) == [(1, "d1"), (2, "d1"), (3, "d2")]
    assert sorted(tuple(r) for r in read(2).collect()) == [(1, "d1"), (3, "d2")]
    assert sorted(tuple(r) for r in read(None).collect()) == [(1, "d1"), (3, "d2"), (9, "d3")]
    files = {f.split("/")[-1] for f in read(2).inputFiles()}
    assert files == {written[2]["d1"].split("/")[-1], written[1]["d2"].split("/")[-1]}
    changed = snapshots.read_between(spark, log, entries, folder, schema, 1, 3)
    assert sorted(tuple(r) for r in changed.collect()) == [(1, "d1", "added"), (1, "d1", "removed"), (2, "d1", "removed"), (9, "d3", "added")]
    assert snapshots.read_between(spark, log, entries, folder, schema, 3, 3).count() == 0


def test_replication_reads_no_row_to_find_partitions(spark, kept, folder, monkeypatch):
    """Partitions come from the log or a listing; only the copy itself reads rows."""
    source_folder, log, entries, _ = kept
    schema = spark.createDataFrame([], "id int, dt string").schema
    asked = []
    monkeypatch.setattr(rep, "partition_values", lambda df, part="dt": asked.append(df) or sorted(r[0] for r in df.select(part).distinct().collect()))
    target = PathTarget(spark, f"{folder}-copy")
    source = snapshots.LogSource(spark, source_folder, schema, log, entries)
    early = log.filter("snapshot_id = 1")
    first = rep.replicate(spark, source, target, f"{folder}-state", "t", early, entries)
    assert (first.mode, first.reloaded) == ("full", ["d1", "d2"])
    second = rep.replicate(spark, source, target, f"{folder}-state", "t", log, entries)
    # d2 was written on a branch meanwhile: loading it again does no harm.
    assert (second.mode, second.reloaded) == ("incremental", ["d1", "d2", "d3"])
    assert sorted(tuple(r) for r in read_published(spark, target.path, schema).collect()) == [(1, "d1"), (3, "d2"), (9, "d3")]
    plain = rep.PathSource(spark, target.path, schema)
    rep.replicate(spark, plain, PathTarget(spark, f"{folder}-again"), f"{folder}-state2", "t", log, entries, full_load=True)
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in asked]
    assert len(plans) >= 4 and not any("FileScan parquet" in p for p in plans)


def test_listing(spark, folder):
    df = spark.range(20).select("id", F.concat(F.lit("2026-01-0"), (F.col("id") % 3).cast("string")).alias("dt"))
    publish_partitions(df, folder)
    files = listing.list_files(spark, folder)
    text = lambda x: x._jdf.queryExecution().executedPlan().toString()
    for found in (listing.listed_partitions(files), listing.newest_partition(files)):
        assert "binaryFile" in text(found) and "FileScan parquet" not in text(found) and "content" not in text(found).split("ReadSchema")[1]
    assert listing.newest_partition(files).first().dt == "2026-01-02"
    assert sorted(r.dt for r in listing.listed_partitions(files).collect()) == ["2026-01-00", "2026-01-01", "2026-01-02"]
    stats = {r.dt: r for r in listing.file_stats(files).collect()}
    assert {k: r.record_count for k, r in stats.items()} == {"2026-01-00": 7, "2026-01-01": 7, "2026-01-02": 6}
    assert all(r.file_count >= 1 and r.total_bytes > 0 for r in stats.values())
    assert listing.list_files(spark, folder + "-none").count() == 0
    with pytest.raises(Exception, match="no partitions found"):
        listing.newest_partition(listing.list_files(spark, folder + "-none")).collect()
