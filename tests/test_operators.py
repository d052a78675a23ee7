"""Operators against brute force on small fixtures, with one key owning a third of the rows."""

import random
from collections import Counter, defaultdict
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from shelfline.operators import modelling, quality, ranking
from shelfline.operators.entities import entity_dimension, entity_mart, mart_for_entities
from shelfline.operators.latest import last_written, latest_by, upsert
from shelfline.operators.ranking import as_of, gated_ranking, top_n, top_ranked
from shelfline.operators.tiers import index_to_base, retained, tier_profile


def skewed(n, keys=40, seed=3):
    """Pairs whose first key owns a third of the rows."""
    rng = random.Random(seed)
    return [(0 if rng.random() < 1 / 3 else rng.randrange(1, keys), rng.randrange(1000)) for _ in range(n)]


def test_latest_by_on_a_hot_key(spark):
    rows = [(k, v, i) for i, (k, v) in enumerate(skewed(6000))]
    want = {}
    for k, v, i in rows:
        want[k] = max(want.get(k, (-1, -1)), (v, i))
    df = spark.createDataFrame(rows, "k int, v int, i int").repartition(7)
    got = {r.k: (r.v, r.i) for r in latest_by(df, ["k"], "v", ("i",)).collect()}
    assert got == want
    assert {r.k: r.i for r in last_written(df, ["k"], "i").collect()} == {
        k: max(i for kk, _, i in rows if kk == k) for k in want
    }


def test_latest_by_prefers_any_version_to_null(spark):
    df = spark.createDataFrame([(1, None, "old"), (1, 5, "new")], "k int, v int, x string")
    assert [r.x for r in latest_by(df, ["k"], "v").collect()] == ["new"]


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, x string")
    updates = spark.createDataFrame([(2, "B", 1), (2, "BB", 2), (9, "n", 1)], "k int, x string, v int")
    merged = upsert(target.withColumn("v", F.lit(0)), updates, ["k"], "v")
    assert sorted((r.k, r.x) for r in merged.collect()) == [(1, "a"), (2, "BB"), (3, "c"), (9, "n")]


@pytest.mark.parametrize("tasks", [1, 4, 256])
@pytest.mark.parametrize("n", [1, 7, 500, 10_000])
def test_top_n_for_any_number_of_tasks(spark, monkeypatch, tasks, n):
    monkeypatch.setattr(ranking, "SPREAD", tasks)
    rows = [(i, v) for i, (_, v) in enumerate(skewed(3000))]
    df = spark.createDataFrame(rows, "i int, v int").repartition(9)
    got = [(r.v, r.i) for r in top_n(df, "v", ["i"], n).collect()]
    assert got == [(v, i) for i, v in sorted(rows, key=lambda r: (-r[1], r[0]))[:n]]


def test_rank_numbers_and_ascending(spark):
    df = spark.createDataFrame([("a", 3), ("b", 3), ("c", None), ("d", 1)], "k string, v int")
    down = top_ranked(df, "v", ["k"], 3).collect()
    assert sorted((r["rank"], r.k) for r in down) == [(1, "a"), (2, "b"), (3, "d")]
    up = top_ranked(df, "v", ["k"], 2, ascending=True).collect()
    assert sorted((r["rank"], r.k) for r in up) == [(1, "d"), (2, "a")]


def test_gated_ranking(spark):
    rows = [(i, i % 50, (i * 37) % 101) for i in range(600)]
    df = spark.createDataFrame(rows, "i int, quality int, volume int")
    pool = sorted(rows, key=lambda r: (-r[1], r[0]))[:100]
    want = [r[0] for r in sorted(pool, key=lambda r: (-r[2], r[0]))[:10]]
    got = gated_ranking(df, "quality", 100, "volume", 10, ["i"]).orderBy("rank").collect()
    assert [r.i for r in got] == want and [r["rank"] for r in got] == list(range(1, 11))


def test_as_of(spark):
    df = spark.createDataFrame([("2026-01-01",), ("2026-01-02",)], "dt string")
    assert as_of(df, "dt", None).count() == 2
    assert [r.dt for r in as_of(df, "dt", "latest").collect()] == ["2026-01-02"]
    assert [r.dt for r in as_of(df, "dt", "2026-01-01").collect()] == ["2026-01-01"]


def test_entity_mart_hot_entity_both_paths(spark):
    rows = [(i, f"studio{k}", v, v // 3, f"2026-01-0{1 + i % 2}") for i, (k, v) in enumerate(skewed(4000))]
    schema = "app_id int, dev string, pos int, neg int, dt string"
    df = spark.createDataFrame(rows, schema).repartition(6)
    want = defaultdict(lambda: [0, 0, 0])
    for _, dev, pos, neg, dt in rows:
        w = want[dev, dt]
        w[0] += 1
        w[1] += pos
        w[2] += neg
    for unique in (False, True):
        mart = entity_mart(df, "dev", "app_id", "pos", "neg", "dt", unique)
        got = {(r.dev, r.dt): [r.num_games, r.total_positive, r.total_negative] for r in mart.collect()}
        assert got == want
    # the exact path counts an item once however often it occurs
    doubled = entity_mart(df.union(df), "dev", "app_id", "pos", "neg", "dt")
    assert {(r.dev, r.dt): r.num_games for r in doubled.collect()} == {k: w[0] for k, w in want.items()}


def test_mart_keeps_entities_without_items(spark):
    entities = spark.createDataFrame([("a", "d"), ("b", "d"), ("b", "d")], "dev string, dt string")
    mart = spark.createDataFrame([("a", "d", 5)], "dev string, dt string, num_games int")
    got = mart_for_entities(entities, mart, "dev", "dt").collect()
    assert sorted((r.dev, r.num_games or 0) for r in got) == [("a", 5), ("b", 0)]


def test_entity_dimension_with_a_date_that_holds_most_names(spark):
    names = [(f"name{i:05d}", "2026-01-02") for i in range(5000)]
    names += [(f"other{i}", f"2026-01-{d:02d}") for d in range(3, 20) for i in range(d)]
    names += [("name00000", "2026-01-01"), (None, "2026-01-01"), ("", "2026-01-01")]
    df = spark.createDataFrame(names * 2, "dev string, dt string").repartition(5)
    previous = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # dates cross partitions
    try:
        got = entity_dimension(df, "dev", "dt", "dev_id").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", previous)
    by_date = defaultdict(list)
    for dev, dt in sorted({n for n in names if n[0]}):
        by_date[dt].append(dev)
    want = {(dev, dt, i) for dt, devs in by_date.items() for i, dev in enumerate(devs)}
    assert {(r.dev, r.dt, r.dev_id) for r in got} == want and len(got) == len(want)


def test_tiers(spark):
    rows = [("0 .. 20,000", 2.0, 0.0), ("0 .. 20,000", 4.0, 0.0), ("20,000 .. 50,000", 6.0, 1.0),
            ("1,000,000 .. 2,000,000", None, 2.0), ("", 100.0, 1.0), (None, 100.0, 1.0)]
    df = spark.createDataFrame(rows, "tier string, x double, y double")
    profile = tier_profile(df, "tier", {"x": F.col("x"), "y": F.col("y")})
    got = {r.label: (r.lo, r.x, r.y) for r in profile.collect()}
    assert got == {"0–20k": (0, 3.0, 0.0), "20k–50k": (20000, 6.0, 1.0), "1M–2M": (1000000, 0.0, 2.0)}
    index = {r.label: (r.x_idx, r.y_idx) for r in index_to_base(profile, "lo", ["x", "y"]).collect()}
    assert index == {"0–20k": (1.0, 0.0), "20k–50k": (2.0, 1.0), "1M–2M": (0.0, 2.0)}  # base 0 -> 1
    assert {r.label for r in retained(profile, "y").collect()} == {"20k–50k", "1M–2M"}


def test_quality(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "b"), (2, "c")], "k int, x string")
    assert {r.column_name: r.failing_rows for r in quality.not_null(df, ["k", "x"]).collect()} == {"k": 1, "x": 1}
    assert [(r.k, r.n_rows) for r in quality.unique_key(df, ["k"]).collect()] == [(1, 2)]
    parent = spark.createDataFrame([(2,)], "id int")
    orphans = quality.relationship(df, "k", parent, "id").collect()
    assert sorted((r.k, r.x or "") for r in orphans) == [(1, ""), (1, "a")]


def test_hot_orphan_key(spark):
    rows = skewed(3000)
    child = spark.createDataFrame(rows, "k int, v int")
    parent = spark.createDataFrame([(k,) for k in range(1, 40)], "id int")
    assert quality.relationship(child, "k", parent, "id").count() == sum(k == 0 for k, _ in rows)


PAGES = {"complete": [0, 1, 2], "gap": [0, 2], "no_first": [1, 2], "twice": [0, 1, 1]}


def test_page_gaps(spark):
    df = spark.createDataFrame([(dt, p) for dt, pages in PAGES.items() for p in pages], "dt string, page int")
    assert {r.dt for r in quality.page_gaps(df).collect()} == {"gap", "no_first", "twice"}
    report = {r.dt: (r.first_page, r.last_page, r.n_pages, r.n_files) for r in quality.page_report(df).collect()}
    assert report["twice"] == (0, 1, 2, 3) and report["gap"] == (0, 2, 2, 2)


def test_history(spark):
    rows = [(1, "a", "d1"), (1, "a", "d2"), (1, "b", "d3"), (1, None, "d4"), (1, None, "d5"), (1, "a", "d6"),
            (2, None, "d1")]
    df = spark.createDataFrame(rows, "k int, x string, dt string")
    got = {tuple(r) for r in modelling.history(df, "k", ["x"], "dt").collect()}
    assert got == {
        (1, "a", "d1", "d3", False), (1, "b", "d3", "d4", False), (1, None, "d4", "d6", False),
        (1, "a", "d6", None, True), (2, None, "d1", None, True),
    }


def test_flag_pivot_and_union(spark):
    people = spark.createDataFrame([(1,), (2,)], "k int")
    gone = spark.createDataFrame([(2,), (2,), (3,)], "k int")
    assert sorted(tuple(r) for r in modelling.flag_deleted(people, gone, "k").collect()) == [(1, False), (2, True)]
    paid = spark.createDataFrame([(1, "F", 2.5), (1, "O", 1.0), (1, "Z", 4.0), (2, "O", 1.0)], "k int, s string, x double")
    pivot = modelling.pivot_sum(paid, ["k"], "s", ["F", "O"], "x", "total")
    assert sorted(tuple(r) for r in pivot.collect()) == [(1, 2.5, 1.0, 7.5), (2, 0.0, 1.0, 1.0)]
    both = modelling.union_sources({"l": people, "r": gone})
    assert Counter(r.source for r in both.collect()) == {"l": 2, "r": 3}


def test_fan_out(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", 0.0), ("c", None), ("d", 1.0)], "k string, q double")
    got = sorted((r.k, r.unit_no) for r in modelling.fan_out(df, "q").collect())
    assert got == [("a", 1), ("a", 2), ("a", 3), ("d", 1)]


def test_funnel_and_spine(spark):
    at = lambda day: datetime(2026, 1, day)
    rows = [(1, "view", at(1)), (1, "buy", at(2)), (2, "buy", at(1)), (2, "view", at(4)), (3, "other", at(4))]
    df = spark.createDataFrame(rows, "who int, step string, ts timestamp")
    got = {r.who: r.steps_reached for r in modelling.funnel(df, "who", "step", "ts", ["view", "buy"]).collect()}
    assert got == {1: 2, 2: 1, 3: 0}
    # A step before its predecessor doesn't spoil a later one.
    again = spark.createDataFrame([(1, "buy", at(1)), (1, "view", at(2)), (1, "buy", at(3))], df.schema)
    assert modelling.funnel(again, "who", "step", "ts", ["view", "buy"]).first().steps_reached == 2
    spine = {r.day: r.n_rows for r in modelling.spine_counts(df, "ts").collect()}
    assert spine == {date(2026, 1, 1): 2, date(2026, 1, 2): 1, date(2026, 1, 3): 0, date(2026, 1, 4): 2}
