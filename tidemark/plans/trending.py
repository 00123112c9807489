"""The three results: events counted, hot topics, and hot topics by country."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import event_time
from tidemark.operators.counts import WINDOW, count_all, count_per_window
from tidemark.operators.intake import (
    decode_messages,
    keep_with_key,
    null_without_key,
    parse_messages,
)
from tidemark.operators.panes import last_panes
from tidemark.operators.ranking import top_n
from tidemark.operators.shaping import bind_category, encode_envelope, format_hot_topics
from tidemark.operators.topics import explode_topics
from tidemark.schemas import GLOBAL_EVENTS, GROUP_ONLY, HOT_TOPICS, MESSAGE, TOPICS_ONLY

REQUIRED_KEY = "venue"
TOP = 10
PANE = 5


def venue_messages(messages: DataFrame, *, strict: bool = False) -> DataFrame:
    """Decoded messages that have a venue: the input both results share."""
    return keep_with_key(decode_messages(messages, strict=strict), REQUIRED_KEY, strict=strict)


def events_count(messages: DataFrame, *, strict: bool = False) -> DataFrame:
    """How many messages have a venue. Reads keys only; nothing else is parsed."""
    return count_all(venue_messages(messages, strict=strict))


def topic_mentions(
    messages: DataFrame,
    *,
    time: str = "publish",
    by_country: bool = False,
    keep: Sequence[str] = (),
    strict: bool = False,
) -> DataFrame:
    """One row per topic mention: ``publish_ts``, any kept columns, ``topic_key, topic_name``.

    ``time="event"`` puts the message's own time in ``publish_ts``.
    """
    group = GROUP_ONLY if by_country or strict else TOPICS_ONLY
    event = time == "event"
    schema = T.StructType([*group.fields, MESSAGE["timestamp"]]) if event else group
    decoded = decode_messages(messages, strict=strict)
    if strict:
        kept = keep_with_key(decoded, REQUIRED_KEY, strict=True)
    else:
        # A message without the key parses to nothing and so has no topics. As one
        # projection this decodes each payload once; filter, then parse, would do it twice.
        kept = null_without_key(decoded, REQUIRED_KEY)
    parsed = parse_messages(kept, schema, strict=strict)
    if event:
        parsed = parsed.withColumn("publish_ts", event_time(F.col("timestamp")))
    carried = ["publish_ts", *keep]
    if by_country:
        parsed = parsed.withColumn("country", F.col("group.group_country"))
        carried.append("country")
    return explode_topics(parsed, carried, strict=strict)


def topic_scores(mentions: DataFrame, *, size: str = WINDOW, watermark: str | None = None) -> DataFrame:
    """Mentions per window and topic."""
    keys = [c for c in ("country",) if c in mentions.columns] + ["topic_key", "topic_name"]
    return count_per_window(mentions, keys, size=size, watermark=watermark)


def rank_topics(scores: DataFrame, n: int = TOP) -> DataFrame:
    """The n best topics of each window (and country); equal scores go by key, then name."""
    per = ["window_start", "window_end"] + [c for c in ("country",) if c in scores.columns]
    return top_n(scores, n, "score", per=per, ties=["topic_key", "topic_name"])


def hot_topics(messages: DataFrame, *, n: int = TOP, size: str = WINDOW, **options) -> DataFrame:
    """Exact top topics per window, from complete counts."""
    return rank_topics(topic_scores(topic_mentions(messages, **options), size=size), n)


def hot_topics_by_panes(
    messages: DataFrame, *, n: int = TOP, every: int = PANE, size: str = WINDOW, **options
) -> DataFrame:
    """Top topics as the count trigger shows them: each score is the topic's last pane,
    and a topic with fewer than ``every`` mentions in a window has fired none."""
    mentions = with_window(topic_mentions(messages, **options), size)
    shown = last_panes(mentions, ["window_start", "window_end", "topic_key", "topic_name"], every, "score")
    return rank_topics(shown, n)


def with_window(df: DataFrame, size: str = WINDOW, time: str = "publish_ts") -> DataFrame:
    """Add the bounds of each row's tumbling window."""
    others = [c for c in df.columns if c != "_window"]
    return df.withColumn("_window", F.window(time, size)).select(
        *others,
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
    )


def count_envelopes(counted: DataFrame, events: str | Column = "events") -> DataFrame:
    output = F.col(events) if isinstance(events, str) else events
    return encode_envelope(bind_category(counted, GLOBAL_EVENTS, output))


def hot_topics_envelopes(ranked: DataFrame) -> DataFrame:
    return encode_envelope(bind_category(format_hot_topics(ranked), HOT_TOPICS))
