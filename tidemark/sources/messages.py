"""Topic messages: payload bytes plus publish time, as a batch table or a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import TOPIC_MESSAGE
from tidemark.workspace import is_single_file


def read_message_files(
    spark: SparkSession,
    path: str,
    *,
    streaming: bool = False,
    schema: T.StructType = TOPIC_MESSAGE,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Parquet files of messages. The schema is given, never inferred."""
    reader = (spark.readStream if streaming else spark.read).schema(schema)
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def read_json_lines(
    spark: SparkSession,
    path: str,
    *,
    streaming: bool = False,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """One payload per line, from all files below ``path``.

    The file's modification time stands in for publish time.
    """
    reader = (spark.readStream if streaming else spark.read).option("recursiveFileLookup", "true")
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path).select(
        F.encode("value", "UTF-8").alias("value"),
        F.col("_metadata.file_modification_time").alias("timestamp"),
    )


def read_kafka(
    spark: SparkSession, servers: str, topic: str, *, streaming: bool = True, **options: str
) -> DataFrame:
    """A Kafka topic in the same shape; headers become ``attributes``. Needs Spark's Kafka package."""
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    reader = reader.option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    reader = reader.option("includeHeaders", "true")
    texts = F.transform("headers", lambda h: F.struct(h["key"], h["value"].cast("string")))
    return reader.options(**options).load().select(
        "value", "timestamp", F.map_from_entries(texts).alias("attributes")
    )


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables; zone-less timestamps become instants in the session zone."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return with_instants(df)


def stream_table(
    spark: SparkSession,
    folder: str,
    name: str,
    *columns: str,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Columns of the same table as a file stream."""
    path = f"{folder}/{name}.parquet"
    table = spark.read.parquet(path)
    reader = spark.readStream.schema(table.schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if is_single_file(spark, path):  # a file stream watches a folder
        path, reader = folder, reader.option("pathGlobFilter", f"{name}.parquet")
    return with_instants(reader.parquet(path)).select(*columns or "*")


def spread(df: DataFrame, least: int) -> DataFrame:
    """Deal the rows of a source that has fewer splits than ``least`` out to so many partitions.

    JSON work is bound by the processor, so a few unsplittable files would leave cores idle. A
    source with enough splits is returned as it is and needs no shuffle.
    """
    return df.repartition(least) if splits(df) < least else df


def splits(df: DataFrame) -> int:
    """The partitions a batch frame is read in."""
    return df.rdd.getNumPartitions()


def with_instants(df: DataFrame) -> DataFrame:
    """Watermarks reject zone-less timestamps, so cast them all on the way in."""
    return df.select(
        *(
            F.col(f.name).cast("timestamp").alias(f.name)
            if isinstance(f.dataType, T.TimestampNTZType)
            else F.col(f.name)
            for f in df.schema.fields
        )
    )
