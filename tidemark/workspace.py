"""Files kept in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not (context.master == "local" or context.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_roots[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used before, below the shared folder."""
    return f"{shared_root(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


def freeze(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage and pins values that a second evaluation could change (such as row
    numbers tied to a partition layout). Being Parquet, later reads still prune
    columns and know their size, and losing an executor loses nothing.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _located(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    filesystem, location = _located(spark, path)
    if not filesystem.exists(location):
        return []
    return [status.getPath().getName() for status in filesystem.listStatus(location)]


def path_exists(spark: SparkSession, path: str) -> bool:
    filesystem, location = _located(spark, path)
    return filesystem.exists(location)


def is_single_file(spark: SparkSession, path: str) -> bool:
    filesystem, location = _located(spark, path)
    return filesystem.getFileStatus(location).isFile()


def delete_folder(spark: SparkSession, path: str) -> None:
    filesystem, location = _located(spark, path)
    filesystem.delete(location, True)


def move_new(spark: SparkSession, path: str, target: str) -> None:
    """Rename a folder to a name that nothing has yet, at once; it is an error if something has.

    The file system must rename atomically, as local disks and HDFS do.
    """
    jvm, names = spark._jvm, spark._jvm.org.apache.hadoop.fs
    source, to = names.Path(path), names.Path(target)
    conf = spark._jsc.hadoopConfiguration()
    context = names.FileContext.getFileContext(source.getFileSystem(conf).getUri(), conf)
    plain = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context.rename(source, to, plain)


def path_segment(spark: SparkSession, column: str, value: str | None) -> str:
    """The name of the folder that Spark gives a value of a partition column."""
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return utils.getPartitionPathString(column, value)
