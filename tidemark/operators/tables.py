"""Writing chosen columns to a table whose schema is a ``{column: type name}`` dict."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.workspace import delete_folder, move_new, path_exists, path_segment

# Warehouse type name -> Spark type. Fixed values.
TYPES = {
    "STRING": "string",
    "BYTES": "binary",
    "INTEGER": "bigint",
    "INT64": "bigint",
    "FLOAT": "double",
    "FLOAT64": "double",
    "NUMERIC": "decimal(38,9)",
    "BOOLEAN": "boolean",
    "BOOL": "boolean",
    "DATE": "date",
    "DATETIME": "timestamp_ntz",
    "TIMESTAMP": "timestamp",
}


def schema_string(schema: Mapping[str, str]) -> str:
    """``col:type, col:type`` in the dict's order."""
    return ", ".join(f"{column}:{kind}" for column, kind in schema.items())


def schema_ddl(schema: Mapping[str, str]) -> str:
    """The same schema as Spark DDL."""
    return ", ".join(f"`{column}` {_spark_type(kind)}" for column, kind in schema.items())


def _spark_type(kind: str) -> str:
    if kind.upper() not in TYPES:
        raise ValueError(f"unknown column type: {kind}")
    return TYPES[kind.upper()]


def select_schema(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """The schema's columns in its order and types; a missing one is an analysis error."""
    return df.select(*(F.col(c).cast(_spark_type(kind)).alias(c) for c, kind in schema.items()))


def write_table(
    df: DataFrame, table: str, schema: Mapping[str, str], *, path: str | None = None
) -> None:
    """Append to a catalog table, kept at ``path`` when given."""
    writer = select_schema(df, schema).write.mode("append").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def write_batch(df: DataFrame, table: str, schema: Mapping[str, str], batch: str, *, path: str) -> bool:
    """Append a named batch to a catalog table kept at ``path``, once: whether it was not there yet.

    The table has ``batch`` as a further column, which splits its files. A batch is written beside
    the table and gets its place by one rename, so readers see all of it or nothing, a write that
    is killed leaves nothing that counts, and the folders are the ledger of what was written. A
    batch that is there already is left as it is, whatever ``df`` holds now; of two writers of one
    batch the first to finish counts. ``table`` is made if it is missing, from any folders there.
    """
    spark = df.sparkSession
    if not batch:
        raise ValueError("a batch needs a name")
    if "batch" in (column.lower() for column in schema):
        raise ValueError("batch is a column of the table's own")
    target = f"{path}/{path_segment(spark, 'batch', batch)}"
    written = False
    if not path_exists(spark, target):
        draft = f"{path}/.draft-{uuid.uuid4().hex}"
        select_schema(df, schema).write.parquet(draft)
        try:
            move_new(spark, draft, target)
            written = True
        except Py4JJavaError:
            delete_folder(spark, draft)
            if not path_exists(spark, target):
                raise
    if not spark.catalog.tableExists(table):
        columns = f"{schema_ddl(schema)}, `batch` string"
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY (batch) LOCATION '{path}'")
        spark.sql(f"MSCK REPAIR TABLE {table}")
    name = batch.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION (batch = '{name}') LOCATION '{target}'")
    return written


def stream_to_table(
    df: DataFrame,
    table: str,
    schema: Mapping[str, str],
    *,
    checkpoint: str,
    path: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append a stream to a catalog table, kept at ``path`` when given."""
    writer = select_schema(df, schema).writeStream.format("parquet").outputMode("append")
    if path is not None:
        writer = writer.option("path", path)
    if trigger is not None:
        writer = writer.trigger(**trigger)
    return writer.option("checkpointLocation", checkpoint).toTable(table)
