"""The staged sink: bounded batches, and nothing visible unless all tasks end well."""

import glob
import os
import subprocess
import sys

import pyarrow as pa
import pyarrow.parquet
import pytest
from pyspark.sql import functions as F

from shelfline.sources import arrow_sink


def visible(folder):
    return sorted(f for f in glob.glob(f"{folder}/**/*.parquet", recursive=True) if "/_" not in f)


def test_rows_arrive_in_bounded_batches(spark, folder):
    df = spark.range(1001).select("id", F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("s"),
                                  F.array("id").alias("list"), F.struct("id").alias("one")).repartition(3)
    assert arrow_sink.write_staged(df, folder, batch_rows=100) == 1001
    got = arrow_sink.read_staged(spark, folder, df.schema)
    assert got.count() == 1001 and got.exceptAll(df).isEmpty()
    sizes = [pa.parquet.read_metadata(f).num_rows for f in visible(folder)]
    assert max(sizes) == 100 and sum(sizes) == 1001
    # One folder a write, nothing left of the staging.
    assert len({os.path.dirname(f) for f in visible(folder)}) == 1 and os.listdir(f"{folder}/_staged") == []
    assert arrow_sink.write_staged(df.limit(10), folder) == 10
    assert arrow_sink.read_staged(spark, folder, df.schema).count() == 1011
    assert arrow_sink.write_staged(df.limit(7), folder, overwrite=True) == 7
    assert arrow_sink.read_staged(spark, folder, df.schema).count() == 7
    assert arrow_sink.write_staged(df.limit(0), folder) == 0


def test_a_failed_task_leaves_nothing_visible(spark, folder):
    df = spark.range(1000).repartition(4)
    arrow_sink.write_staged(df, folder)
    before = visible(folder)
    broken = df.select(F.when(F.col("id") == 900, F.raise_error(F.lit("broken row"))).otherwise(F.col("id")).cast("bigint").alias("id"))
    for overwrite in (False, True):
        with pytest.raises(Exception, match="broken row"):
            arrow_sink.write_staged(broken, folder, batch_rows=10, overwrite=overwrite)
        assert visible(folder) == before
    assert arrow_sink.read_staged(spark, folder, df.schema).count() == 1000


def test_attempts_that_do_not_count(folder):
    """Files of an attempt without a message are thrown away, as are those of another attempt of the same task."""
    writer = arrow_sink.StagedWriter(folder, 10, False)
    staged = f"{folder}/_staged/{writer.job}"
    for name in ("000000-1", "000000-2"):
        os.makedirs(f"{staged}/{name}")
        pa.parquet.write_table(pa.table({"id": [int(name[-1])]}), f"{staged}/{name}/part-000000-000000.parquet")
    writer.commit([arrow_sink.Attempt(f"{staged}/000000-2", 1), None])
    assert [pa.parquet.read_table(f).to_pydict() for f in visible(folder)] == [{"id": [2]}]
    writer.abort([])


def test_batches_are_cut_and_joined():
    writer = arrow_sink.StagedWriter("/x", 4, False)
    batch = lambda n: pa.RecordBatch.from_pydict({"id": list(range(n))})
    assert [t.num_rows for t in writer._batches(iter([batch(3), batch(0), batch(2), batch(9)]))] == [4, 4, 4, 2]
    assert list(writer._batches(iter([batch(0)]))) == []


def test_without_the_package_on_the_executors(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
from shelfline.session import get_spark
from shelfline.sources import arrow_sink
spark = get_spark("elsewhere", master="local[2]", conf={{"spark.ui.enabled": "false"}})
assert arrow_sink.write_staged(spark.range(10), {str(tmp_path / "out")!r}) == 10
"""
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=clean, check=True, timeout=120)
    assert sum(pa.parquet.read_metadata(f).num_rows for f in visible(tmp_path / "out")) == 10
