"""Replication sequences: each must leave the target equal to the source."""

import os
import random
from datetime import datetime, timedelta

import pytest

from shelfline.operators import replication as rep
from shelfline.sources.files import drop_partitions
from shelfline.sources.sinks import PathTarget, TableTarget, publish_partitions
from shelfline.sources.tables import modified_partitions, read_published

SCHEMA = "id int, v int, dt string"
START = datetime(2026, 1, 1)


class Source:
    """A published table with a commit log of the shape replication reads."""

    def __init__(self, spark, folder):
        self.spark, self.path = spark, f"{folder}/source"
        self.log, self.files = [], []

    def _commit(self, snapshot, dates, status):
        self.log.append((snapshot, START + timedelta(hours=len(self.log))))
        self.files += [(status, snapshot, ((dt,),)) for dt in dates]

    def write(self, snapshot, rows):
        publish_partitions(self.spark.createDataFrame(rows, SCHEMA), self.path)
        self._commit(snapshot, sorted({r[2] for r in rows}), rep.ADDED)

    def drop(self, snapshot, dates):
        drop_partitions(self.spark, self.path, dates)
        self._commit(snapshot, dates, rep.DELETED)

    @property
    def snapshots(self):
        return self.spark.createDataFrame(self.log, "snapshot_id bigint, committed_at timestamp")

    @property
    def entries(self):
        return self.spark.createDataFrame(
            self.files, "status int, snapshot_id bigint, data_file struct<partition: struct<dt: string>>"
        )

    def read(self, _=None):
        schema = self.spark.createDataFrame([], SCHEMA).schema
        return read_published(self.spark, self.path, schema)


class Replica:
    def __init__(self, source, folder, target=None):
        self.source, self.state = source, f"{folder}/state"
        self.target = target or PathTarget(source.spark, f"{folder}/target")

    def run(self, read=None, **kw):
        s = self.source
        return rep.replicate(
            s.spark, read or s.read, self.target, self.state, "t", s.snapshots, s.entries, **kw
        )

    def rows(self):
        spark = self.source.spark
        if isinstance(self.target, TableTarget):
            return sorted(tuple(r) for r in spark.table(self.target.table).collect())
        schema = spark.createDataFrame([], SCHEMA).schema
        return sorted(tuple(r) for r in read_published(spark, self.target.path, schema).collect())

    def in_step(self):
        return self.rows() == sorted(tuple(r) for r in self.source.read().collect())

    def last(self):
        return rep.last_replicated(rep.read_state(self.source.spark, self.state), "t")


@pytest.fixture(params=["path", "table"])
def pair(request, spark, folder):
    source = Source(spark, folder)
    source.write(500, [(1, 1, "d1"), (2, 1, "d1"), (1, 1, "d2")])
    table = TableTarget(spark, "replica_" + folder.rsplit("-", 1)[1])
    return source, Replica(source, folder, table if request.param == "table" else None)


def test_no_state_then_up_to_date(pair):
    source, replica = pair
    assert replica.last() is None
    first = replica.run()
    assert (first.mode, first.reloaded, first.rows) == ("full", ["d1", "d2"], 3) and replica.in_step()
    assert replica.last() == 500
    assert replica.run() == rep.Outcome("none", [], [], 0)


def test_rewritten_appended_and_deleted_partitions(pair):
    source, replica = pair
    replica.run()
    source.write(7, [(1, 2, "d1")])  # a smaller id, committed later
    source.write(900, [(5, 5, "d3")])
    source.drop(8, ["d2"])
    outcome = replica.run()
    assert (outcome.mode, outcome.reloaded, outcome.cleared) == ("incremental", ["d1", "d3"], ["d2"])
    assert replica.in_step() and replica.last() == 8 and replica.run().mode == "none"


def test_only_a_deletion(pair):
    source, replica = pair
    replica.run()
    source.drop(3, ["d1"])
    outcome = replica.run()
    assert (outcome.reloaded, outcome.cleared, outcome.rows) == ([], ["d1"], 0) and replica.in_step()


def test_commit_during_the_copy_is_left_to_the_next_run(pair):
    source, replica = pair
    replica.run()
    source.write(20, [(1, 3, "d1")])
    snapshots, entries = source.snapshots, source.entries

    def read(_):
        if len(source.log) == 2:
            source.write(10, [(9, 9, "d9")])
        return source.read()

    rep.replicate(source.spark, read, replica.target, replica.state, "t", snapshots, entries)
    assert replica.last() == 20
    outcome = replica.run()
    assert outcome.reloaded == ["d9"] and replica.in_step() and replica.last() == 10


def test_crash_before_state_replays(pair, monkeypatch):
    source, replica = pair
    replica.run()
    source.write(600, [(1, 4, "d2")])

    def crash(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(rep, "record_state", crash)
    with pytest.raises(RuntimeError):
        replica.run()
    assert replica.last() == 500
    monkeypatch.undo()
    assert replica.run().reloaded == ["d2"] and replica.in_step() and replica.last() == 600


def test_full_load_override_and_expired_state(pair):
    source, replica = pair
    replica.run()
    source.write(30, [(1, 5, "d4")])
    source.write(40, [(1, 6, "d5")])
    assert replica.run(from_snapshot=30).reloaded == ["d5"]  # exclusive start
    assert replica.run(full_load=True).reloaded == ["d1", "d2", "d4", "d5"] and replica.in_step()
    rep.record_state(source.spark, replica.state, "t", 123456)  # unknown id
    assert replica.run().mode == "full" and replica.in_step()


def test_override_zero_is_an_id(pair):
    source, replica = pair
    source.write(0, [(1, 1, "d3")])
    source.write(60, [(1, 1, "d4")])
    plan = rep.replication_plan(source.snapshots, source.entries, source.read(), last=60, from_snapshot=0)
    assert plan.mode == "incremental" and [r.dt for r in plan.partitions.collect()] == ["d4"]


def test_full_load_clears_stale_target_partitions(pair):
    source, replica = pair
    replica.run()
    source.drop(1, ["d1"])
    outcome = replica.run(full_load=True)
    assert outcome.cleared == ["d1"] and replica.target.partitions() == {"d2"}


def test_no_snapshots_is_an_error(spark):
    empty = spark.createDataFrame([], "snapshot_id bigint, committed_at timestamp")
    with pytest.raises(Exception, match="no snapshots found"):
        rep.newest_snapshot_id(empty)


def test_same_commit_time_is_not_missed(spark):
    snapshots = spark.createDataFrame([(1, START), (2, START)], "snapshot_id bigint, committed_at timestamp")
    entries = spark.createDataFrame(
        [(1, 2, (("d1",),)), (1, 2, ((None,),)), (0, 2, (("kept",),))],
        "status int, snapshot_id bigint, data_file struct<partition: struct<dt: string>>",
    )
    assert [r.dt for r in rep.changed_partitions(snapshots, entries, since=1).collect()] == ["d1"]


def test_modification_times(spark, pair):
    source, _ = pair
    seen = max(r.modified_at for r in modified_partitions(source.read()).collect())
    assert rep.partitions_modified_since(modified_partitions(source.read()), None).count() == 2
    source.write(1, [(1, 1, "d2"), (1, 1, "d8")])
    changed = rep.partitions_modified_since(modified_partitions(source.read()), seen)
    assert sorted(r.dt for r in changed.collect()) == ["d2", "d8"]


def test_state_is_compacted(spark, folder, monkeypatch):
    count = lambda: len([f for f in os.listdir(folder) if f.endswith(".parquet")])
    for i in range(7):
        rep.record_state(spark, folder, f"t{i % 3}", i, most=4)
        assert count() <= 5
    state = rep.read_state(spark, folder)
    assert [rep.last_replicated(state, f"t{k}") for k in range(4)] == [6, 4, 5, None]
    # A crash before the old files go leaves rows twice, which changes nothing.
    monkeypatch.setattr(rep, "drop_folders", lambda *_: None)
    rep.compact_state(spark, folder)
    assert [rep.last_replicated(rep.read_state(spark, folder), f"t{k}") for k in range(3)] == [6, 4, 5]
    monkeypatch.undo()
    rep.compact_state(spark, folder)
    assert count() == 1 and rep.read_state(spark, folder).count() == 3


def test_tables_run_in_order_and_retry():
    calls = []

    def flaky():
        calls.append("a")
        if calls.count("a") < 2:
            raise OSError("once")
        return rep.Outcome("none", [], [], 0)

    def broken():
        calls.append("b")
        raise OSError("always")

    def fine():
        calls.append("c")
        return rep.Outcome("none", [], [], 0)

    assert set(rep.replicate_tables({"a": flaky, "c": fine})) == {"a", "c"}
    with pytest.raises(RuntimeError, match="b"):
        rep.replicate_tables({"b": broken, "c": fine})
    assert calls == ["a", "a", "c", "b", "b", "c"]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_histories_end_in_step(spark, folder, seed):
    """Whatever commits happen between runs, an incremental run equals a full load."""
    rng = random.Random(seed)
    source = Source(spark, folder)
    source.write(rng.randrange(10**6), [(0, 0, "d0"), (0, 0, "d1")])
    replica = Replica(source, folder)
    for step in range(4):
        for _ in range(rng.randrange(3)):
            dates = [f"d{rng.randrange(5)}" for _ in range(rng.randrange(1, 3))]
            snapshot = rng.randrange(10**6, 10**9)
            existing = [r.dt for r in source.read().select("dt").distinct().collect()]
            if rng.random() < 0.3 and len(existing) > 1:
                source.drop(snapshot, [rng.choice(existing)])
            else:
                source.write(snapshot, [(i, step, dt) for dt in dates for i in range(rng.randrange(1, 4))])
        replica.run()
        assert replica.in_step() and replica.last() == source.log[-1][0]
    full = Replica(source, folder + "-full")
    full.run(full_load=True)
    assert full.rows() == replica.rows()
