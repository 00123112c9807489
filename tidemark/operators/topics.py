"""Group and topic flattening."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_topics(df: DataFrame, keep: Sequence[str] = (), *, strict: bool = False) -> DataFrame:
    """One row per topic of ``group``: the kept columns, ``topic_key``, ``topic_name``.

    Repeated topics stay repeated; an empty list gives no row. So does a missing one,
    unless strict, where a group without country or list is an error. Key and name stay
    two columns, so any character may appear in either.
    """
    topics = F.col("group.group_topics")
    if strict:
        complete = topics.isNotNull() & F.col("group.group_country").isNotNull()
        broken = F.raise_error(F.lit("group without group_country or group_topics"))
        topics = F.when(complete, topics).otherwise(broken.cast(df.select(topics).schema[0].dataType))
    return df.select(*keep, F.inline(topics).alias("topic_key", "topic_name"))
