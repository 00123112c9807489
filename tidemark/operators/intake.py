"""From payload bytes to typed message columns."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.once import once
from tidemark.functions.payload import decode_utf8, has_key, is_unusable, is_whole, parse_json
from tidemark.operators.ranking import first_by_key
from tidemark.schemas import MESSAGE, TOPICS_ONLY


def decode_messages(messages: DataFrame, *, strict: bool = False) -> DataFrame:
    """Replace the ``value`` bytes by ``text``, and call the transport's time ``publish_ts``."""
    others = [c for c in messages.columns if c not in ("value", "timestamp")]
    return messages.select(
        *others,
        decode_utf8(F.col("value"), strict).alias("text"),
        F.col("timestamp").alias("publish_ts"),
    )


def keep_with_key(df: DataFrame, key: str, *, text: str = "text", strict: bool = False) -> DataFrame:
    """Keep JSON objects that have ``key``, even with a null value.

    Broken text is dropped (see `quarantine`), or is an error when strict.
    """
    present = has_key(F.col(text), key) & is_whole(F.col(text))
    if strict:
        readable = is_whole(F.col(text))
        broken = F.raise_error(F.concat(F.lit("malformed message: "), F.col(text)))
        present = F.coalesce(F.when(readable, present), F.when(readable, F.lit(False)).otherwise(broken.cast("boolean")))
    return df.filter(present)


def null_without_key(df: DataFrame, key: str, *, text: str = "text") -> DataFrame:
    """Keep every row, but only the text that `keep_with_key` would keep."""
    present = has_key(F.col(text), key) & is_whole(F.col(text))
    return df.withColumn(text, F.when(present, F.col(text)))


def quarantine(df: DataFrame, *, text: str = "text") -> DataFrame:
    """The rows no plan can use: undecodable, broken, with text after the object, or not an object."""
    return df.filter(is_unusable(F.col(text)))


def quarantine_groups(df: DataFrame, *, text: str = "text") -> DataFrame:
    """Usable messages whose topics cannot be read: no group, no topic list, or a bad element in it.

    They count as events but would have no topics.
    """
    fields = parse_json(F.col(text), TOPICS_ONLY)
    topics = once(F.when(~is_unusable(F.col(text)), F.struct(fields["group"]["group_topics"].alias("list"))))
    lost = F.col("_topics").isNotNull() & (
        F.col("_topics.list").isNull() | F.exists("_topics.list", lambda t: t.isNull())
    )
    return df.select(*df.columns, topics.alias("_topics")).filter(lost).select(*df.columns)


def parse_messages(
    df: DataFrame, schema: T.StructType = MESSAGE, *, text: str = "text", strict: bool = False
) -> DataFrame:
    """Replace the text by the fields of ``schema``. Pass a narrow schema for a narrow parse."""
    others = [c for c in df.columns if c != text]
    message = once(parse_json(F.col(text), schema, strict)).alias("_message")
    return df.select(*others, message).select(*others, "_message.*")


def drop_duplicate_messages(
    df: DataFrame, *, key: str = "event_id", time: str = "publish_ts", delay: str = "1 hour"
) -> DataFrame:
    """One message per id, the earliest; messages without an id all stay. Off in the ready-made plans.

    A stream keeps the first to arrive, and forgets an id once the watermark is ``delay``
    past it. Either way each map task sends on few copies of an id delivered very often.
    """
    if df.isStreaming:
        fewer = df.mapInArrow(_first_per_batch(key), df.schema)
        known = fewer.withColumn("_nameless", F.when(F.col(key).isNull(), F.uuid())).withWatermark(time, delay)
        return known.dropDuplicatesWithinWatermark([key, "_nameless"]).drop("_nameless")
    others: Sequence[str] = [c for c in df.columns if c not in (key, time) and not isinstance(df.schema[c].dataType, T.MapType)]
    named = df.withColumn("_nameless", F.when(F.col(key).isNull(), F.monotonically_increasing_id()))
    return first_by_key(named, [key, "_nameless"], [time, *others]).drop("_nameless")


def _first_per_batch(key: str):
    """Keep the first row of each key in every Arrow batch.

    A stream cannot combine before its shuffle by itself, so all copies of an id would go
    to the one task that holds its state.
    """

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbered = pa.table({"key": batch.column(key), "row": np.arange(batch.num_rows)})
            named = numbered.filter(pa.compute.is_valid(numbered["key"]))
            first = named.group_by("key").aggregate([("row", "min")])["row_min"]
            nameless = numbered.filter(pa.compute.is_null(numbered["key"]))["row"]
            yield batch.take(pa.chunked_array([*first.chunks, *nameless.chunks], pa.int64()).combine_chunks())

    return keep
