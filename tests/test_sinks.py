import glob
import json
import os
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from shelfline.session import SHUFFLE_CLEANUP, materialize, shuffles_dropped
from shelfline.sources import sinks, tables
from shelfline.sources.files import drop_partitions, list_partitions, path_exists
from shelfline.sources.tables import read_published


def frame(spark, per_date):
    rows = [(i, dt) for dt, n in per_date.items() for i in range(n)]
    return spark.createDataFrame(rows, "id int, dt string")


def counts(df):
    return {r.dt: r.n_rows for r in sinks.partition_counts(df).collect()}


def test_publish_replaces_only_given_partitions(spark, folder):
    df = frame(spark, {"2026-01-01": 5, "2026-01-02": 3})
    assert sinks.publish_partitions(df, folder) == 8
    for rebalance in (True, False):
        assert sinks.publish_partitions(frame(spark, {"2026-01-02": 9}), folder, rebalance=rebalance) == 9
        assert counts(read_published(spark, folder, df.schema)) == {"2026-01-01": 5, "2026-01-02": 9}
    assert read_published(spark, folder, df.schema).schema["dt"].dataType.simpleString() == "string"
    assert counts(read_published(spark, folder, df.schema, ["2026-01-01"])) == {"2026-01-01": 5}
    drop_partitions(spark, folder, ["2026-01-01"])
    assert list_partitions(spark, folder) == ["2026-01-02"]
    assert path_exists(spark, folder) and not path_exists(spark, folder + "-no")


def test_a_write_leaves_no_shuffle_files(spark, folder, shuffle_files):
    """A chain of writes would otherwise keep those of all of them."""
    df = frame(spark, {"2026-01-01": 50, "2026-01-02": 30}).repartition(4)
    df.hint("rebalance", "dt").write.parquet(f"{folder}/plain")
    assert shuffle_files(wait=0)
    kept = len(shuffle_files(wait=0))
    sinks.publish_partitions(df, f"{folder}/published")
    sinks.write_in_batches(df, sinks.JsonLines(f"{folder}/lines"))
    end = time.time() + 5
    while len(shuffle_files(wait=0)) > kept and time.time() < end:
        time.sleep(0.1)
    assert len(shuffle_files(wait=0)) <= kept
    assert counts(read_published(spark, f"{folder}/published", df.schema)) == {"2026-01-01": 50, "2026-01-02": 30}
    assert df.count() == 80 and sinks.write_in_batches(df, sinks.JsonLines(f"{folder}/lines")) == 80


def test_dropping_shuffles_leaves_the_setting_as_it_was(spark):
    with pytest.raises(KeyError), shuffles_dropped(spark):
        with shuffles_dropped(spark):
            pass
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
        raise KeyError
    assert spark.conf.get(SHUFFLE_CLEANUP, None) is None
    spark.conf.set(SHUFFLE_CLEANUP, "false")
    with shuffles_dropped(spark):
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
    assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
    spark.conf.unset(SHUFFLE_CLEANUP)


def test_a_hot_date_is_written_by_several_tasks(spark, folder):
    """A third of the rows share a date; with a small advisory size it must not be one task's work."""
    df = spark.range(300_000).select(
        "id", F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") % 3 == 0, "2026-01-01")
        .otherwise(F.concat(F.lit("2026-02-"), F.lpad((F.col("id") % 20 + 1).cast("string"), 2, "0")))
        .alias("dt"),
    ).repartition(16)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "1m")
    try:
        assert sinks.publish_partitions(df, folder) == 300_000
    finally:
        spark.conf.unset(key)
    assert len(glob.glob(f"{folder}/dt=2026-01-01/*.parquet")) > 3
    stats = {r.dt: r for r in tables.partition_stats(read_published(spark, folder, df.schema)).collect()}
    assert stats["2026-01-01"].record_count == 100_000 and stats["2026-01-01"].total_bytes > 0
    assert sum(r.record_count for r in stats.values()) == 300_000


def test_verify(spark, folder):
    df = frame(spark, {"a": 5, "b": 3})
    sinks.verify_counts(df, df)
    with pytest.raises(ValueError, match="row counts differ"):
        sinks.verify_counts(df, df.filter("dt = 'a'"))
    report = {r.dt: (r.expected_rows, r.actual_rows) for r in sinks.count_report(df, frame(spark, {"b": 3, "c": 1})).collect()}
    assert report == {"a": (5, 0), "b": (3, 3), "c": (0, 1)}
    sinks.publish_partitions(df, folder)
    sinks.verify_written(read_published(spark, folder, df.schema), 8, "t")
    with pytest.raises(ValueError, match="t: wrote 7 rows, found 5"):
        sinks.verify_written(read_published(spark, folder, df.schema, ["a"]), 7, "t")


def test_publish_table_creates_then_overwrites(spark, folder):
    name = "t" + folder.rsplit("-", 1)[1]
    df = frame(spark, {"2026-01-01": 2, "2026-01-02": 3})
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    assert sinks.publish_table(df, name, location=folder) == 5
    assert sinks.publish_table(frame(spark, {"2026-01-02": 1}), name) == 1
    assert counts(spark.table(name)) == {"2026-01-01": 2, "2026-01-02": 1}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_batch_sink(spark, folder):
    df = frame(spark, {"a": 700, "b": 301}).repartition(3)
    assert sinks.write_in_batches(df, sinks.JsonLines(folder), batch_rows=100) == 1001
    files = glob.glob(f"{folder}/*.json")
    batches = [[json.loads(line) for line in open(f, encoding="utf-8")] for f in files]
    assert max(map(len, batches)) == 100 and sum(map(len, batches)) == 1001
    # a second attempt overwrites its files
    assert sinks.write_in_batches(df, sinks.JsonLines(folder), batch_rows=100) == 1001
    assert len(glob.glob(f"{folder}/*.json")) == len(files)
    assert sinks.write_in_batches(df.limit(0), sinks.JsonLines(folder)) == 0


@pytest.mark.parametrize("uri, plain", [
    ("/a/b", "/a/b"), ("file:/a/b", "/a/b"), ("file:///a/b", "/a/b"), ("s3a://k/a", "s3://k/a"),
    ("hdfs://n/a", "hdfs://n/a"),
])
def test_file_store_paths(uri, plain):
    assert sinks.FileStore(uri).uri == plain


def test_batch_sink_without_the_package_on_the_executors(tmp_path):
    """Only the driver knows where the package is."""
    code = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from shelfline.session import get_spark
from shelfline.sources import sinks
spark = get_spark("elsewhere", master="local[2]", conf={{"spark.ui.enabled": "false"}})
assert sinks.write_in_batches(spark.range(10), sinks.JsonLines({str(tmp_path / "out")!r})) == 10
"""
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=clean, check=True, timeout=120)
    assert sum(len(open(f).readlines()) for f in glob.glob(f"{tmp_path}/out/*.json")) == 10


def test_batch_sink_failure_reaches_the_caller(spark):
    def broken(task, batch, rows):
        raise OSError("sink is down")

    with pytest.raises(Exception, match="sink is down"):
        sinks.write_in_batches(frame(spark, {"a": 1}), broken)


def test_scans(spark, folder):
    df = frame(spark, {"2025-12-31": 1, "2026-01-01": 2, "2026-01-02": 3})
    sinks.publish_partitions(df, folder)
    table = read_published(spark, folder, df.schema)
    assert tables.scan_partitions(table, "2026-01-01").count() == 2
    assert tables.scan_partitions(table, ["2025-12-31", "2026-01-02"]).count() == 4
    wanted = spark.createDataFrame([("2026-01-02",), ("2026-01-02",), ("x",)], "dt string")
    assert tables.scan_partitions(table, wanted).count() == 3
    assert tables.scan_glob(spark, folder, "dt=2026-*", df.schema).count() == 5
    assert tables.partition_values(table) == ["2025-12-31", "2026-01-01", "2026-01-02"]
    assert tables.latest_partition_row(table).collect()[0].dt == "2026-01-02"
    with pytest.raises(Exception, match="no partitions found"):
        tables.latest_partition_row(table.limit(0)).collect()


def test_json_and_describe(spark):
    df = spark.createDataFrame([(1, '{"a": 1, "b": "x"}'), (2, '{"a": null}'), (3, "broken"), (4, None)], "id int, doc string")
    assert {r.key: r.n_docs for r in tables.json_keys(df, "doc").collect()} == {"a": 2, "b": 1}
    entries = tables.json_entries(df, "doc", ["id"]).collect()
    assert sorted((r.id, r.key, r.value or "") for r in entries) == [(1, "a", "1"), (1, "b", "x"), (2, "a", "")]
    assert [tuple(r) for r in tables.describe(df).orderBy("ordinal").collect()] == [
        (1, "id", "int", 4), (2, "doc", "string", 3),
    ]


def test_publish_drops_emptied_and_odd_values(spark, folder):
    sinks.publish_partitions(frame(spark, {"v:0": 3, "o'b": 2, "x": 1}), folder)
    assert list_partitions(spark, folder) == ["o'b", "v:0", "x"]
    left = frame(spark, {"v:0": 4})
    sinks.publish_partitions(left, folder, replaced=["v:0", "o'b"])
    assert list_partitions(spark, folder) == ["v:0", "x"]
    assert read_published(spark, folder, left.schema, ["v:0"]).count() == 4


def test_publish_table_goes_by_name(spark):
    rows = spark.createDataFrame([(1, 2, "a")], "pos int, neg int, dt string")
    sinks.publish_table(rows, "by_name")
    sinks.publish_table(rows.select("neg", F.lit(9).alias("pos"), "dt"), "by_name")
    assert [(r.pos, r.neg) for r in spark.table("by_name").collect()] == [(9, 2)]
    with pytest.raises(ValueError):
        sinks.publish_table(rows.drop("neg"), "by_name")


def test_materialize(spark):
    df = spark.range(3).withColumn("dt", F.lit("a"))
    assert materialize(df, "m_view", "view").count() == 3 and spark.catalog.tableExists("m_view")
    assert materialize(df, "m_inline", "inline") is df and not spark.catalog.tableExists("m_inline")
    for _ in range(2):
        stored = materialize(df, "m_table", "table", partition="dt")
        assert sorted(tuple(r) for r in stored.collect()) == [(0, "a"), (1, "a"), (2, "a")]
    with pytest.raises(ValueError):
        materialize(df, "m", "snapshot")
