"""Session settings the transforms rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Pin what results depend on; leave every sizing choice to the cluster.

    Times are formatted and zone-less timestamps are cast in the session zone, so it
    has to be the same everywhere. A repeated JSON key keeps its last value in
    ``from_json``; the second setting makes VARIANT parsing agree. The third changes no result:
    it lets Spark cut groups to the rows a rank asks for in the map tasks, above 1000 rows too.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", str(2**31 - 1))
    return spark


def use_rocksdb_state(spark: SparkSession) -> SparkSession:
    """Keep streaming state on executor disks with changelog checkpoints.

    Must run before a stateful query starts; `transformWithState` needs it.
    """
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return spark


def local_session(cores: int | str = "*", app: str = "tidemark", **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    partitions = "8" if cores == "*" else str(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)
