"""Merges by partition, bucketed serving tables, distinct states, listings of a session."""

import glob
import os
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shelfline.operators.distinct import distinct_counts, distinct_states, merged_states
from shelfline.operators.latest import latest_by
from shelfline.sources import merge, serving, tables
from shelfline.sources.checked import Gate, GateError
from shelfline.sources.files import list_partitions
from shelfline.sources.sinks import publish_partitions
from shelfline.sources.tables import read_published

SCHEMA = "id int, v int, dt string"


def content(spark, folder, schema=SCHEMA):
    rows = read_published(spark, folder, spark.createDataFrame([], schema).schema).collect()
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r))


def stamps(folder):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{folder}/dt=*/*.parquet")}


def run(spark, folder, rows, **kw):
    updates = spark.createDataFrame(rows, SCHEMA)
    return merge.merge_partitions(spark, folder, updates.schema, updates, ["id"], **kw)


def test_merge_rewrites_touched_partitions_only(spark, folder):
    publish_partitions(spark.createDataFrame([(1, 1, "d1"), (2, 2, "d1"), (3, 3, "d2"), (4, 4, "d3"), (5, 5, "d4")], SCHEMA), folder)
    before = stamps(folder)
    # 2 changes, 3 moves from d2 to d1, 9 is new in a new partition.
    done = run(spark, folder, [(2, 20, "d1"), (3, 30, "d1"), (9, 90, "d9")])
    assert (done.rewritten, done.cleared) == (["d1", "d9"], ["d2"])
    assert content(spark, folder) == [(1, 1, "d1"), (2, 20, "d1"), (3, 30, "d1"), (4, 4, "d3"), (5, 5, "d4"), (9, 90, "d9")]
    after = stamps(folder)
    assert {f for f in before if "dt=d3" in f or "dt=d4" in f} <= set(after)
    assert all(after[f] == t for f, t in before.items() if f in after) and not any("dt=d1" in f and f in before for f in after)
    assert run(spark, folder, []).rewritten == [] and stamps(folder) == after


def test_merge_into_nothing_versions_and_gates(spark, folder):
    assert run(spark, folder, [(1, 1, "d1")]).rewritten == ["d1"]
    assert run(spark, folder, [(1, 5, "d1"), (1, 7, "d2")], version="v").rewritten == ["d2"]
    assert content(spark, folder) == [(1, 7, "d2")]
    with pytest.raises(GateError, match="unique"):
        run(spark, folder, [(1, 5, "d2"), (1, 6, "d2")])
    with pytest.raises(GateError, match="small"):
        run(spark, folder, [(2, 500, "d2")], gates=[Gate("v is small", "v < 100")])
    assert content(spark, folder) == [(1, 7, "d2")]
    run(spark, folder, [(None, 1, "d2")])
    assert len(content(spark, folder)) == 2


def test_merge_by_a_key_with_the_partition(spark, folder, monkeypatch):
    """Keys can't move then, so the target is not searched for them."""
    rows = spark.createDataFrame([(1, 1, "d1"), (1, 2, "d2"), (2, 2, "d3")], SCHEMA)
    publish_partitions(rows, folder)
    read = []
    monkeypatch.setattr(merge, "read_published", lambda s, p, schema, values=None, part="dt": read.append(values) or read_published(s, p, schema, values, part))
    merge.merge_partitions(spark, folder, rows.schema, spark.createDataFrame([(1, 9, "d2")], SCHEMA), ["id", "dt"])
    assert read == [["d2"]] and content(spark, folder) == [(1, 1, "d1"), (1, 9, "d2"), (2, 2, "d3")]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_merges_like_a_dictionary(spark, folder, seed):
    rng = random.Random(seed)
    want = {}
    for step in range(4):
        batch = {rng.randrange(30): (rng.randrange(100), f"d{rng.randrange(6)}") for _ in range(rng.randrange(1, 12))}
        want.update(batch)
        run(spark, folder, [(k, v, dt) for k, (v, dt) in batch.items()])
        assert content(spark, folder) == sorted((k, v, dt) for k, (v, dt) in want.items())
        assert list_partitions(spark, folder) == sorted({dt for _, dt in want.values()})


def test_newest_versions_without_an_exchange(spark, folder):
    name = "serving_" + folder.rsplit("-", 1)[1]
    rows = [(f"k{i % 40}", i, i * 7 % 11) for i in range(400)] + [("hot", 1000 + i, i) for i in range(200)] + [(None, 1, 1), (None, 2, 2)]
    df = spark.createDataFrame(rows, "k string, version int, v int")
    for part in (0, 1, 2):
        serving.append_bucketed(df.filter(F.col("version") % 3 == part), name, ["k"], 4, ["k", "version"], folder)
    newest = serving.newest_versions(spark, name, ["k"], "version", ("v",))
    text = newest._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Bucketed: true" in text and "SelectedBucketsCount: 4 out of 4" in text
    assert sorted(map(str, newest.collect())) == sorted(map(str, latest_by(df, ["k"], "version", ("v",)).collect()))
    # A load adds one file to each bucket at most.
    assert len(glob.glob(f"{folder}/*.parquet")) <= 12


def test_distinct_states(spark):
    random.seed(2)
    rows = [(random.choice(["hot", "a", "b"]), f"d{random.randrange(3)}", random.choice([0, 5, -7, 32767, 32768, 10**12 + random.randrange(9), None]))
            for _ in range(3000)]
    df = spark.createDataFrame(rows, "e string, dt string, id long").repartition(6)
    states = distinct_states(df, ["e", "dt"], "id")
    want, ever = defaultdict(set), defaultdict(set)
    for e, dt, i in rows:
        if i is not None:
            want[e, dt].add(i)
            ever[e].add(i)
    got = {(r.e, r.dt): r.n for r in distinct_counts(states, ["e", "dt"], "n").collect()}
    assert got == {k: len(v) for k, v in want.items()}
    # Rolled up over dates, also in two steps, and with a date added twice.
    both = states.unionByName(states.filter("dt = 'd1'"))
    assert {r.e: r.n for r in distinct_counts(both, ["e"], "n").collect()} == {k: len(v) for k, v in ever.items()}
    assert {r.e: r.n for r in distinct_counts(merged_states(both, ["e"]), ["e"], "n").collect()} == {k: len(v) for k, v in ever.items()}
    text = states._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "partial_bitmap_construct_agg" in text
    assert distinct_counts(distinct_states(df.limit(0), ["e"], "id"), ["e"], "n").count() == 0


def test_states_of_scattered_ids_are_small(spark):
    """A state a key and id is the usual case, so neither its bytes nor those of Spark's aggregates may be shuffled or sorted."""
    df = spark.range(2000).select((F.col("id") % 100).alias("e"), (F.col("id") % 3).alias("dt"), (F.col("id") * 100_003 - 10**8).alias("id"))
    states = distinct_states(df, ["e", "dt"], "id")
    merged = merged_states(states, ["e"])
    for found in (states, merged):
        assert found.agg(F.max(F.octet_length("ids"))).first()[0] <= 64
    assert sum(r.n for r in distinct_counts(states, ["e"], "n").collect()) == 2000
    for found, name in ((states, "bitmap_construct_agg"), (merged, "bitmap_or_agg")):
        lines = found._jdf.queryExecution().executedPlan().toString().splitlines()
        last = next(i for i, line in enumerate(lines) if "Aggregate" in line)
        # the two steps of the aggregate follow each other
        assert "Aggregate" in lines[last + 1] and f"partial_{name}" in lines[last + 1]


def test_states_of_dense_ids_of_both_signs(spark):
    df = spark.range(-3000, 3000).select(F.lit("hot").alias("e"), "id")
    df = df.unionByName(df.filter("id % 2 = 0")).unionByName(spark.createDataFrame([(None, 7), (None, None)], "e string, id long"))
    got = {r.e: r.n for r in distinct_counts(distinct_states(df, ["e"], "id"), ["e"], "n").collect()}
    assert got == {"hot": 6000, None: 1}


def test_list_tables(spark):
    spark.range(7).withColumn("x", F.lit(1)).createOrReplaceTempView("shown_a")
    spark.range(0).createOrReplaceTempView("shown_b")
    assert sorted(tuple(r) for r in tables.list_tables(spark, "shown_*").collect()) == [("shown_a", True, 2, 7), ("shown_b", True, 1, 0)]
    assert tables.list_tables(spark, "nothing_*").count() == 0


def test_array_elements(spark):
    df = spark.createDataFrame([(1, [5, None]), (2, []), (3, None)], "id int, a array<int>")
    assert sorted(tables.array_elements(df, "a", ["id"]).collect(), key=str) == [(1, 0, 5), (1, 1, None)]
