"""The top-N family: global or per key, largest or smallest, one entry per key.

Ranks are total: ``ties`` columns decide between equal scores, smallest first. All of it is for
batch frames, those of a stream's ``foreachBatch`` included.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.names import free_names

#: With more rows asked for, a group's tasks are merged in two steps.
SHARED_ABOVE = 1000

Ordering = str | Column | Sequence[str | Column]


def _columns(columns: Ordering) -> list[Column]:
    if isinstance(columns, (str, Column)):
        columns = [columns]
    return [F.col(c) if isinstance(c, str) else c for c in columns]


def top_n(
    df: DataFrame,
    n: int,
    by: Ordering,
    *,
    per: Sequence[str] = (),
    reverse: bool = False,
    ties: Ordering = (),
    distinct_on: Sequence[str] = (),
    seq: Ordering = (),
    rank: str = "rank",
    shares: int | None = None,
) -> DataFrame:
    """The ``n`` greatest rows (least, when ``reverse``), in each ``per`` group if given.

    ``by`` holds names or any Column expressions, compared in turn; extra arguments of an
    ordering are literals in it, or ``one_row_df.scalar()``. Nulls rank last either way.
    ``distinct_on`` keeps one row per key first: the latest by ``seq``, or without ``seq``
    the best ranked.

    ``rank`` is the place from 1; a column of that name is replaced.

    Lazy at every ``n``, and each map task sends on at most ``n`` rows of a group. Up to
    `SHARED_ABOVE` rows of a task meet in one task per group; for more, ``shares`` tasks cut a group
    to ``n`` rows each first, so a merge sees ``n`` rows for every share. ``shares`` sets their number,
    0 for none: with very many small groups that step only costs a shuffle.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    order = [c.asc_nulls_last() if reverse else c.desc_nulls_last() for c in _columns(by)]
    order += [c.asc_nulls_last() for c in _columns(ties)]
    if distinct_on:
        keys = [*per, *distinct_on]
        latest = [c.desc_nulls_last() for c in _columns(seq)] + order
        df = _head_by_key(df, keys, latest)

    if shares is None:
        shares = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) if n > SHARED_ABOVE else 0
    if shares:
        df = _cut_by_shares(df, n, order, per, shares)
    place = F.row_number().over(Window.partitionBy(*per).orderBy(*order))
    (place_col,) = free_names(df, "_place")
    if per:
        ranked = df.withColumn(place_col, place).filter(F.col(place_col) <= n)
    else:  # the limit cuts in the map tasks without numbering; only n rows are numbered
        ranked = df.orderBy(*order).limit(n).withColumn(place_col, place)
    others = [c for c in df.columns if c != rank]
    return ranked.select(*others, F.col(place_col).cast("bigint").alias(rank))


def _cut_by_shares(df: DataFrame, n: int, order: Sequence[Column], per: Sequence[str], shares: int) -> DataFrame:
    """Keep each group's best ``n`` of every share of the map tasks: all of its best ``n`` overall
    are among them. Which tasks make up a share does not matter to what is ranked later."""
    share, place = free_names(df, "_share", "_place")
    shared = df.withColumn(share, F.spark_partition_id() % shares)
    best = F.row_number().over(Window.partitionBy(*per, share).orderBy(*order))
    return shared.withColumn(place, best).filter(F.col(place) <= n).select(*df.columns)


def _head_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    (place,) = free_names(df, "_place")
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(place, position).filter(F.col(place) == 1).select(*df.columns)


def latest_by_key(df: DataFrame, keys: Sequence[str], seq: Ordering) -> DataFrame:
    """The newest row of each key by ``seq``, even if an older one scored higher.

    Each map task drops all but its own newest row per key before the shuffle.
    """
    return _head_by_key(df, keys, [c.desc_nulls_last() for c in _columns(seq)])


def first_by_key(df: DataFrame, keys: Sequence[str], seq: Ordering) -> DataFrame:
    """The oldest row of each key by ``seq``."""
    return _head_by_key(df, keys, [c.asc_nulls_last() for c in _columns(seq)])


def largest(df: DataFrame, n: int, by: Ordering, **options) -> DataFrame:
    return top_n(df, n, by, **options)


def smallest(df: DataFrame, n: int, by: Ordering, **options) -> DataFrame:
    return top_n(df, n, by, reverse=True, **options)


def largest_per_key(
    df: DataFrame, n: int, by: Ordering, per: Sequence[str], **options
) -> DataFrame:
    return top_n(df, n, by, per=per, **options)


def smallest_per_key(
    df: DataFrame, n: int, by: Ordering, per: Sequence[str], **options
) -> DataFrame:
    return top_n(df, n, by, per=per, reverse=True, **options)


def top_n_list(
    df: DataFrame,
    n: int,
    by: Ordering,
    *,
    item: Column | None = None,
    per: Sequence[str] = (),
    name: str = "top",
    **options,
) -> DataFrame:
    """`top_n` as a best-first array, one row per group; ungrouped empty input gives ``[]``.

    ``item`` is what to hold for each row, by default a struct of all ungrouped columns.
    """
    (rank,) = free_names(df, "_rank")
    ranked = top_n(df, n, by, per=per, rank=rank, **options)
    if item is None:
        item = F.struct(*(c for c in df.columns if c not in per))
    return ranks_to_list(ranked, item, per=per, rank=rank, name=name)


def ranks_to_list(
    ranked: DataFrame, item: Column, *, per: Sequence[str], rank: str = "rank", name: str = "top"
) -> DataFrame:
    """Gather rows already cut to n per group into one array in rank order."""
    pairs = F.sort_array(F.collect_list(F.struct(F.col(rank).alias("at"), item.alias("item"))))
    return ranked.groupBy(*per).agg(F.transform(pairs, lambda pair: pair["item"]).alias(name))


def resort_list(items: Column, less_than: Callable[[Column, Column], Column]) -> Column:
    """Order an array greatest first by a free-form ``less_than(a, b)`` of two elements."""
    return F.array_sort(
        items,
        lambda a, b: F.when(less_than(a, b), F.lit(1)).when(less_than(b, a), F.lit(-1)).otherwise(F.lit(0)),
    )
