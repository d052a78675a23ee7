"""Folder-level helpers on the Hadoop file system of a path (control plane only, no rows)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _paths(spark: SparkSession):
    """Spark's own escaping of partition values in folder names."""
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils


def partition_folder(spark: SparkSession, part: str, value: str) -> str:
    return f"{part}={_paths(spark).escapePathName(value)}"


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _path(spark, path)
    return fs.exists(hadoop_path)


def list_partitions(spark: SparkSession, path: str, part: str = "dt") -> list[str]:
    """Partition values named by the folders directly below a path."""
    hadoop_path, fs = _path(spark, path)
    if not fs.exists(hadoop_path):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(hadoop_path)]
    return sorted(_paths(spark).unescapePathName(n.split("=", 1)[1]) for n in names if n.startswith(f"{part}="))


def modified(spark: SparkSession, path: str) -> int:
    """Modification time of a file or folder, in milliseconds."""
    hadoop_path, fs = _path(spark, path)
    return fs.getFileStatus(hadoop_path).getModificationTime()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Paths of the files and folders directly below a path."""
    hadoop_path, fs = _path(spark, path)
    return sorted(status.getPath().toString() for status in fs.listStatus(hadoop_path))


def catalog_partitions(spark: SparkSession, table: str) -> list[str]:
    """Partition values of a catalog table with one partition column, as the catalog has them."""
    names = [r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    return sorted(_paths(spark).unescapePathName(n.split("=", 1)[1]) for n in names)


def latest_partition(spark: SparkSession, path: str, part: str = "dt") -> str:
    values = list_partitions(spark, path, part)
    if not values:
        raise ValueError(f"no {part}= partitions below {path}")
    return values[-1]


def drop_partitions(spark: SparkSession, path: str, values: list[str], part: str = "dt") -> None:
    """Remove whole partitions of a published table."""
    for value in values:
        hadoop_path, fs = _path(spark, f"{path}/{partition_folder(spark, part, value)}")
        if fs.exists(hadoop_path) and not fs.delete(hadoop_path, True):
            raise OSError(f"can't delete {hadoop_path}")


def drop_folders(spark: SparkSession, *paths: str) -> None:
    """Remove folders with all they hold, if they exist."""
    for path in paths:
        hadoop_path, fs = _path(spark, path)
        if fs.exists(hadoop_path) and not fs.delete(hadoop_path, True):
            raise OSError(f"can't delete {hadoop_path}")


def swap_folders(spark: SparkSession, source: str, target: str, folders: list[str]) -> None:
    """Move folders below `source` to the same place below `target`, in place of what is there."""
    for folder in folders:
        new, fs = _path(spark, f"{source}/{folder}")
        old, _ = _path(spark, f"{target}/{folder}")
        fs.mkdirs(old.getParent())
        if fs.exists(old) and not fs.delete(old, True):
            raise OSError(f"can't delete {old}")
        if not fs.rename(new, old):
            raise OSError(f"can't move {new} to {old}")
