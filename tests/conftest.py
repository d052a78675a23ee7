import glob
import os
import sys
import tempfile
import time

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfline.session import get_spark, run_dir  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = get_spark("tests", master="local[4]", conf={
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "6g",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="warehouse-"),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    """A local path in the shared folder that no other test uses."""
    return run_dir(spark, "test").removeprefix("file:")


@pytest.fixture
def shuffle_files(spark):
    """The shuffle files of `least` bytes and more written since the test began that are still there; they go a moment after
    they are dropped."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def present(least=0):
        found = [f for d in manager.localDirs() for f in glob.glob(f"{d.getPath()}/*/shuffle_*.data")]
        return {f for f in found if os.path.exists(f) and os.path.getsize(f) >= least}

    before = present()

    def left(wait=5.0, least=0):
        end = time.time() + wait
        while (new := present(least) - before) and time.time() < end:
            time.sleep(0.1)
        return new

    return left


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
