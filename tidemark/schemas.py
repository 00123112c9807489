"""Message and result schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# Category names: fixed values shared with every consumer of the output.
HOT_TOPICS = "HOT_TOPICS"
TOPICS_PER_COUNTRY = "TOPICS_PER_COUNTRY"
GLOBAL_EVENTS = "GLOBAL_EVENTS"

TOPIC = T.StructType(
    [T.StructField("urlkey", T.StringType()), T.StructField("topic_name", T.StringType())]
)
GROUP = T.StructType(
    [
        T.StructField("group_country", T.StringType()),
        T.StructField("group_topics", T.ArrayType(TOPIC)),
    ]
)

# `event_id` and `timestamp` may arrive as JSON numbers or strings, so they are read as
# text and cast; `event` and `venue` are opaque and stay JSON text.
MESSAGE = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("group", GROUP),
        T.StructField("event", T.StringType()),
        T.StructField("response", T.StringType()),
        T.StructField("venue", T.StringType()),
    ]
)

# The same with the opaque fields as VARIANT, for plans that look into them. An absent field is
# NULL and a JSON null is a variant that holds null.
OPEN_MESSAGE = T.StructType(
    [T.StructField(f.name, T.VariantType()) if f.name in ("event", "venue") else f for f in MESSAGE.fields]
)

# Narrow reads: each plan parses only the fields it uses.
TOPICS_ONLY = T.StructType(
    [T.StructField("group", T.StructType([T.StructField("group_topics", T.ArrayType(TOPIC))]))]
)
GROUP_ONLY = T.StructType([T.StructField("group", GROUP)])

# What a source hands over: the payload bytes and the time the transport published them.
TOPIC_MESSAGE = T.StructType(
    [T.StructField("value", T.BinaryType()), T.StructField("timestamp", T.TimestampType())]
)

# The same with the message's attributes, such as its id, which need no parsing.
ATTRIBUTED_MESSAGE = T.StructType(
    [*TOPIC_MESSAGE.fields, T.StructField("attributes", T.MapType(T.StringType(), T.StringType()))]
)

RANKED_TOPIC = T.StructType(
    [
        T.StructField("topic_key", T.StringType()),
        T.StructField("topic_name", T.StringType()),
        T.StructField("score", T.LongType()),
    ]
)
HOT_TOPICS_OUTPUT = T.StructType(
    [
        T.StructField("topics", T.ArrayType(RANKED_TOPIC)),
        T.StructField("timestamp", T.LongType()),
        T.StructField(
            "window",
            T.StructType(
                [T.StructField("start", T.StringType()), T.StructField("end", T.StringType())]
            ),
        ),
    ]
)
