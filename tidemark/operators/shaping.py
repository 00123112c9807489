"""Result records, their envelope, and the way back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.once import once
from tidemark.functions.payload import decode_utf8, encode_json, is_unusable, parse_json
from tidemark.functions.times import format_time, pane_timestamp
from tidemark.operators.ranking import ranks_to_list
from tidemark.schemas import GLOBAL_EVENTS, HOT_TOPICS, HOT_TOPICS_OUTPUT

_ENVELOPE = T.StructType(
    [T.StructField("category", T.StringType()), T.StructField("output", T.StringType())]
)


def format_hot_topics(ranked: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Ranked rows to one record per window: ``topics`` best first, ``timestamp``, ``window``."""
    item = F.struct("topic_key", "topic_name", "score")
    per = ["window_start", "window_end", *extra]
    listed = ranks_to_list(ranked, item, per=per, name="topics")
    return listed.select(
        *extra,
        "topics",
        pane_timestamp(F.col("window_end")).alias("timestamp"),
        F.struct(
            format_time(F.col("window_start")).alias("start"),
            format_time(F.col("window_end")).alias("end"),
        ).alias("window"),
    )


def bind_category(df: DataFrame, category: str, output: Column | None = None) -> DataFrame:
    """Each row as ``category, output``; the output is the whole row unless given."""
    if output is None:
        output = F.struct(*df.columns)
    return df.select(F.lit(category).alias("category"), output.alias("output"))


def encode_envelope(tagged: DataFrame) -> DataFrame:
    """``category, output`` to one JSON ``value``, null fields kept."""
    return tagged.select(encode_json(F.struct("category", "output")).alias("value"))


def decode_delivery(deliveries: DataFrame, data: str = "data") -> DataFrame:
    """Base64 JSON payloads to ``category`` and ``output`` (JSON text); broken ones raise.

    Other columns are kept.
    """
    text = decode_utf8(F.unbase64(data), strict=True)
    envelope = parse_json(text, _ENVELOPE, strict=True)
    others = [c for c in deliveries.columns if c != data]
    return deliveries.select(*others, once(envelope).alias("_envelope")).select(*others, "_envelope.*")


def examine_deliveries(
    deliveries: DataFrame, data: str = "data", known: Sequence[str] = (HOT_TOPICS, GLOBAL_EVENTS)
) -> DataFrame:
    """`decode_delivery` for deliveries of any kind: ``data`` and the other columns stay, and beside
    ``category`` and ``output`` stands a ``reason`` if no store can take the delivery, else null.

    Reasons are ``not base64``, ``not UTF-8``, ``not a JSON object``, ``unknown category`` and ``unreadable
    output``: a record without topics or time, or a count that is no whole number.
    """
    others = [c for c in deliveries.columns if c not in ("category", "output", "reason")]
    raw = F.try_to_binary(F.col(data), F.lit("base64"))
    text = decode_utf8(raw)
    found = F.struct(
        F.when(raw.isNull(), F.lit("not base64"))
        .when(text.isNull(), F.lit("not UTF-8"))
        .when(is_unusable(text), F.lit("not a JSON object"))
        .alias("broken"),
        parse_json(text, _ENVELOPE).alias("envelope"),
    )
    envelope = deliveries.select(*others, once(found).alias("_found")).select(
        *others, F.col("_found.envelope.category").alias("category"), F.col("_found.envelope.output").alias("output"), F.col("_found.broken").alias("reason")
    )
    record = parse_json(_output_of(HOT_TOPICS), HOT_TOPICS_OUTPUT)
    unreadable = (
        F.when(F.col("category") == HOT_TOPICS, record["topics"].isNull() | record["timestamp"].isNull())
        .when(F.col("category") == GLOBAL_EVENTS, F.col("output").try_cast("bigint").isNull())
        .otherwise(F.lit(False))
    )
    unknown = ~F.coalesce(F.col("category").isin(*known), F.lit(False))
    reason = F.coalesce(F.col("reason"), F.when(unknown, F.lit("unknown category")).when(unreadable, F.lit("unreadable output")))
    return envelope.withColumn("reason", reason)


def route(
    envelopes: DataFrame, category: str, known: Sequence[str] = (HOT_TOPICS, GLOBAL_EVENTS)
) -> DataFrame:
    """The rows of one category. A category outside ``known`` in the input is an error."""
    unknown = F.raise_error(
        F.concat(F.lit("unknown category: "), F.coalesce("category", F.lit("none")))
    )
    mine = (
        F.when(F.col("category") == category, F.lit(True))
        .when(F.col("category").isin(*known), F.lit(False))
        .otherwise(unknown.cast("boolean"))
    )
    return envelopes.filter(mine)


def routed_hot_topics(envelopes: DataFrame) -> DataFrame:
    """The hot-topics records with typed fields, beside the other columns."""
    record = parse_json(_output_of(HOT_TOPICS), HOT_TOPICS_OUTPUT, strict=True)
    others = _beside_output(envelopes)
    kept = route(envelopes, HOT_TOPICS).select(*others, once(record).alias("_record"))
    return kept.select(*others, "_record.*")


def routed_counts(envelopes: DataFrame) -> DataFrame:
    """The counter's values as ``events``, beside the other columns."""
    events = _output_of(GLOBAL_EVENTS).cast("bigint").alias("events")
    return route(envelopes, GLOBAL_EVENTS).select(*_beside_output(envelopes), events)


def _output_of(category: str) -> Column:
    # Catalyst may test a parsed field before the route's own filter, so never parse a
    # record of another category.
    return F.when(F.col("category") == category, F.col("output"))


def _beside_output(envelopes: DataFrame) -> list[str]:
    return [c for c in envelopes.columns if c not in ("category", "output")]
