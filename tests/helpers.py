"""Small message frames made by hand."""

import datetime as dt
import json

from pyspark.sql import functions as F

START = dt.datetime(2024, 5, 1, 12, 0, 0, tzinfo=dt.timezone.utc)


def message(topics, *, event_id=1, country="us", **fields):
    """Message text; topics are (key, name) pairs. A venue is present unless venue=ABSENT."""
    fields.setdefault("venue", {"venue_id": 1})
    body = {
        "event_id": event_id,
        "timestamp": 1714564800000,
        "group": {
            "group_country": country,
            "group_topics": [{"urlkey": k, "topic_name": n} for k, n in topics],
        },
        **fields,
    }
    return json.dumps({k: v for k, v in body.items() if v is not ABSENT})


ABSENT = object()


def messages(spark, payloads):
    """A message frame from texts or bytes, or (payload, seconds after START) pairs."""
    rows = []
    for payload in payloads:
        body, after = payload if isinstance(payload, tuple) else (payload, 0)
        body = body.encode() if isinstance(body, str) else body
        rows.append((bytearray(body), START + dt.timedelta(seconds=after)))
    return spark.createDataFrame(rows, "value binary, timestamp timestamp")


def texts(spark, *payloads):
    return spark.createDataFrame([(p,) for p in payloads], "text string")


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def as_text(column):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")
