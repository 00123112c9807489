"""Counts, global and per key and window.

Every count is a partial aggregate before its shuffle, so a key holding any share of the
rows reaches the reducer as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = "10 minutes"


def count_all(df: DataFrame, name: str = "events") -> DataFrame:
    """One row with the number of rows; no row at all for empty input."""
    counted = df.agg(F.count(F.lit(1)).alias(name))
    return counted if df.isStreaming else counted.filter(F.col(name) > 0)


def count_per_key(df: DataFrame, keys: Sequence[str], name: str = "score") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def count_per_window(
    df: DataFrame,
    keys: Sequence[str] = (),
    *,
    time: str = "publish_ts",
    size: str = WINDOW,
    watermark: str | None = None,
    name: str = "score",
) -> DataFrame:
    """Count per key in epoch-aligned tumbling windows: ``window_start, window_end, *keys, score``.

    ``watermark`` bounds the state of a stream; rows later than that are dropped.
    """
    if watermark is not None and df.isStreaming:
        df = df.withWatermark(time, watermark)
    counted = df.groupBy(F.window(time, size).alias("_window"), *keys).agg(
        F.count(F.lit(1)).alias(name)
    )
    return counted.select(
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
        *keys,
        name,
    )
