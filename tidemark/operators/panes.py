"""Count-triggered accumulating panes: the running count of a key each time it grows by n.

These replay the trigger over a batch; `tidemark.streaming.panes` runs it on a stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.counts import count_per_key
from tidemark.operators.positions import with_positions

# Panes made from one row in one go; a key with more is spread over tasks first.
_CHUNK = 10_000


def count_panes(
    df: DataFrame, keys: Sequence[str], every: int, name: str = "running_count"
) -> DataFrame:
    """Every pane a key fires: running counts ``every``, ``2 * every``, ... with pane numbers.

    The values follow from the key's total alone, so nothing is sorted or numbered: one
    partial aggregate, then the multiples up to each total.
    """
    totals = count_per_key(df, keys, "_total").filter(F.col("_total") >= every)
    fired = expand_counts(totals, F.lit(every), F.col("_total"), every, name)
    return fired.select(*keys, _pane_number(name, every), name)


def last_panes(
    df: DataFrame, keys: Sequence[str], every: int, name: str = "running_count"
) -> DataFrame:
    """The latest pane of each key: `latest_by_key` of `count_panes`, without making the others."""
    totals = count_per_key(df, keys, "_total").filter(F.col("_total") >= every)
    return totals.select(*keys, (F.col("_total") - F.col("_total") % every).alias(name))


def fired_panes(
    df: DataFrame,
    keys: Sequence[str],
    every: int,
    order_by: Sequence[Column],
    name: str = "running_count",
) -> DataFrame:
    """Panes with the row that fired each: every ``every``-th row of a key."""
    numbered = with_positions(df, order_by, keys, name)
    fired = numbered.filter(F.col(name) % every == 0)
    return fired.select(*df.columns, _pane_number(name, every), name)


def expand_counts(
    df: DataFrame, first: Column, last: Column, every: int, name: str
) -> DataFrame:
    """One row per count ``first, first + every, ...`` up to ``last``, in place of each row.

    A row that stands for very many counts is first cut into chunks, and the chunks are
    shared out, so no task and no array grows with the largest key.
    """
    span = every * _CHUNK
    step = F.lit(every).cast("bigint")
    bounded = df.withColumn("_from", first.cast("bigint")).withColumn("_to", last.cast("bigint"))
    size = F.col("_to") - F.col("_from")

    def spread(rows: DataFrame) -> DataFrame:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        starts = F.sequence("_from", "_to", F.lit(span).cast("bigint"))
        return (
            rows.filter(size >= 0)
            .withColumn("_from", F.explode(starts))
            .withColumn("_to", F.least("_to", F.col("_from") + span - 1))
            .repartition(partitions, *df.columns, "_from")
        )

    if df.isStreaming:  # a union would run the stateful operator below it twice
        chunks = spread(bounded)
    else:  # rows of one chunk need no shuffle; both sides reuse the one below
        small = bounded.filter((size >= 0) & (size < span))
        chunks = small.unionByName(spread(bounded.filter(size >= span)))
    return chunks.withColumn(name, F.explode(F.sequence("_from", "_to", step))).drop("_from", "_to")


def _pane_number(count: str, every: int) -> Column:
    return F.expr(f"`{count}` div {every}").alias("pane")
