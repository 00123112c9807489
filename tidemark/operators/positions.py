"""Exact row numbers at any group size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.names import free_names
from tidemark.workspace import freeze

# `monotonically_increasing_id` puts the partition in the bits above these.
ROW_BITS = 33


def with_positions(
    df: DataFrame,
    order_by: Sequence[Column],
    per: Sequence[str] = (),
    name: str = "position",
) -> DataFrame:
    """Number the rows of each ``per`` group from 1 in the given order. Batch only.

    ``row_number`` sends a whole group to one task. Here the rows are range-partitioned
    on group and order together, so a large group spans as many partitions as it needs,
    and each row's number is its place in its slice plus the rows of its group in earlier
    slices. Only the per-slice counts are aggregated: at most one row per group and slice.

    The map task's id is the last range column, so that even rows which are copies of each
    other can be split. The rows are frozen before that step, which samples its input by running
    it, and after it: the numbering belongs to one physical layout and must not be evaluated
    twice. So pass only the columns that matter.
    """
    source, at, slice_, rows, first, of_slice, shift = free_names(
        df, "_source", "_at", "_slice", "_rows", "_first", "_of_slice", "_shift"
    )
    groups = {c: free_names(df, f"_per_{c}")[0] for c in per}
    once = freeze(df.withColumn(source, F.spark_partition_id()), "positions-input")
    placed = (
        once.repartitionByRange(*per, *order_by, F.col(source))
        .sortWithinPartitions(*per, *order_by)
        .drop(source)
        .withColumn(at, F.monotonically_increasing_id())
    )
    frozen = freeze(placed.withColumn(slice_, F.shiftright(at, ROW_BITS)), "positions")

    sizes = frozen.groupBy(*per, slice_).agg(F.count(F.lit(1)).alias(rows), F.min(at).alias(first))
    earlier = Window.partitionBy(*per).orderBy(slice_).rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        *(F.col(c).alias(group) for c, group in groups.items()),
        F.col(slice_).alias(of_slice),
        (F.coalesce(F.sum(rows).over(earlier), F.lit(0)) - F.col(first) + 1).alias(shift),
    )
    same = F.col(slice_) == F.col(of_slice)
    for c, group in groups.items():
        same = same & F.col(c).eqNullSafe(F.col(group))
    return frozen.join(shifts, same).select(*df.columns, (F.col(at) + F.col(shift)).alias(name))
