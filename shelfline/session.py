"""Session factory, storage settings, shared work folders and materialisation."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Memory, executor counts and shuffle widths belong to the cluster, not here.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rankings keep up to this many rows a task before the shuffle.
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    # dt=2026-01-01 folders must stay strings.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def s3a_conf(endpoint: str, access_key: str, secret_key: str) -> dict[str, str]:
    """Object-store settings; the caller supplies the credentials."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.path.style.access": "true",
    }


def iceberg_rest_conf(catalog: str, uri: str, warehouse: str) -> dict[str, str]:
    """Registers an Iceberg REST catalog; needs the Iceberg runtime jar on the cluster."""
    prefix = f"spark.sql.catalog.{catalog}"
    return {
        prefix: "org.apache.iceberg.spark.SparkCatalog",
        f"{prefix}.type": "rest",
        f"{prefix}.uri": uri,
        f"{prefix}.warehouse": warehouse,
        f"{prefix}.io-impl": "org.apache.iceberg.aws.s3.S3FileIO",
    }


def get_spark(app: str, master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`.

    Only a local-mode session without that setting gets a fresh temporary folder, which goes when the program ends.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="shelfline-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", base)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses, with its file system spelled out, so
    that readers and writers outside Spark resolve it alike."""
    sc = spark.sparkContext
    base = sc._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    base = base.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(base).toString()
    return f"{base}/{sc.applicationId}/{name}-{uuid.uuid4().hex}"


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes and queries inside go when each of them ends, not when the driver happens to collect its
    garbage: a chain of large writes keeps those of one at a time. What runs beside it in the same session may drop its own
    too, which costs nothing but a repeated stage if one DataFrame is collected twice."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    if before == "true":
        # Also if another thread set it: only the one that did sets it back.
        yield
        return
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def clean_runs(spark: SparkSession) -> None:
    """Removes the work tables of this application. What still reads one of them fails afterwards, so call it when
    its results are written."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{sc.applicationId}")
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str, kind: str = "view", partition: str | None = None,
                location: str | None = None) -> DataFrame:
    """Layer materialisation: staging = view, intermediate = inline, marts and metrics = table."""
    if kind == "inline":
        return df
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        writer = df.write.mode("overwrite").format("parquet")
        if partition:
            writer = writer.partitionBy(partition)
        (writer.option("path", location) if location else writer).saveAsTable(name)
    else:
        raise ValueError(f"unknown materialisation: {kind}")
    return df.sparkSession.table(name)
