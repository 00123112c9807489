"""Raw records to topic messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.once import once

# Message field <- raw field. Fixed values of the two formats.
_FIELDS = {
    "event_id": "rsvp_id",
    "timestamp": "mtime",
    "group": "group",
    "event": "event",
    "response": "response",
    "venue": "venue",
}


def project_records(raw: DataFrame, text: str = "text") -> DataFrame:
    """Rename and narrow raw JSON records: ``event_id, timestamp, value`` (JSON text).

    Values pass through untouched as VARIANT, so unknown inner fields survive, a field
    that was absent stays absent and one that was null stays null. Other columns of
    ``raw`` are kept.
    """
    others = [c for c in raw.columns if c != text]
    parsed = raw.select(*others, once(F.parse_json(text)).alias("_record"))
    payload = F.struct(
        *(
            F.variant_get("_record", f"$.{source}", "variant").alias(target)
            for target, source in _FIELDS.items()
        )
    )
    return parsed.select(
        *others,
        F.variant_get("_record", "$.rsvp_id", "bigint").alias("event_id"),
        F.variant_get("_record", "$.mtime", "bigint").alias("timestamp"),
        F.to_json(payload).alias("value"),
    )


def with_attributes(df: DataFrame) -> DataFrame:
    """Add the ``attributes`` map of id and time as strings; a missing one is an error."""

    def required(name: str):
        missing = F.raise_error(F.lit(f"record without {name}"))
        return F.coalesce(F.col(name).cast("string"), missing.cast("string"))

    return df.withColumn(
        "attributes",
        F.create_map(
            F.lit("event_id"), required("event_id"), F.lit("timestamp"), required("timestamp")
        ),
    )
