"""The `events` table told as raw records and as topic messages.

Payloads are built as text because `to_json` cannot tell a null field from an absent one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.once import once

# Country by user, fixed values of the test data's reshaping rule.
COUNTRIES = ("us", "gb", "fr", "de", "es")


def country() -> Column:
    return F.element_at(
        F.array(*(F.lit(c) for c in COUNTRIES)), (F.col("user_id") % len(COUNTRIES) + 1).cast("int")
    )


def _group() -> Column:
    digit = (F.get_json_object("props", "$.k").cast("bigint") % 10).cast("string")
    kind = F.col("event_type")
    capitalised = F.concat(F.upper(F.substring(kind, 1, 1)), kind.substr(F.lit(2), F.length(kind)))
    return F.concat(
        F.lit('{"group_country":"'), country(),
        F.lit('","group_topics":[{"urlkey":"'), kind,
        F.lit('","topic_name":"'), capitalised,
        F.lit('"},{"urlkey":"k'), digit,
        F.lit('","topic_name":"Topic '), digit,
        F.lit('"}]}'),
    )


def _venue() -> Column:
    kind = F.col("user_id") % 4
    return (
        F.when(kind == 0, F.lit(""))
        .when(kind == 1, F.lit(',"venue":null'))
        .otherwise(F.concat(F.lit(',"venue":{"venue_id":'), F.col("user_id"), F.lit("}")))
    )


def _number(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("null"))


def _payload(id_field: str, time_field: str, event: Column) -> Column:
    return F.concat(
        F.lit(f'{{"{id_field}":'), _number(F.col("event_id")),
        F.lit(f',"{time_field}":'), _number(F.unix_millis("ts")),
        F.lit(',"group":'), _group(),
        event,
        F.lit(',"response":"yes"'), _venue(), F.lit("}"),
    )


def messages_from_events(events: DataFrame, *keep: str) -> DataFrame:
    """``value`` (bytes) and ``timestamp`` (publish time), plus any columns to keep."""
    text = _payload("event_id", "timestamp", F.lit(""))
    return events.select(
        *keep, once(F.encode(text, "UTF-8")).alias("value"), F.col("ts").alias("timestamp")
    )


def attributed_messages_from_events(events: DataFrame, *keep: str) -> DataFrame:
    """The same messages with the attributes a collector gives them: id and time, as text."""
    attributes = F.create_map(
        F.lit("event_id"), F.col("event_id").cast("string"), F.lit("timestamp"), F.unix_millis("ts").cast("string")
    )
    own = [c for c in keep if c not in ("event_id", "ts")]
    return messages_from_events(events.withColumn("attributes", attributes), "attributes", "event_id", *own)


def raw_records_from_events(events: DataFrame) -> DataFrame:
    """``text``: records as they come before projection, with fields it must drop."""
    event = F.concat(F.lit(',"event":{"name":"'), F.col("event_type"), F.lit('"},"guests":0'))
    return events.select(once(_payload("rsvp_id", "mtime", event)).alias("text"))
