"""The either-or trigger: a pane after so many rows, or so long after its first row, whichever is first.

Then the trigger starts over, and each pane carries the key's whole count so far. A pane that
opens with row ``i`` ends before row ``n(i)``: ``every`` rows on, or at the first row that is not
before its deadline. So panes are a chain of jumps, each of which depends on the one before, and
a key's rows can be of any number. They are cut into slices in the order of time, and

1. each slice tells, for each of its first ``every`` rows, with what open pane (rows in it, and its
   deadline) it would be left if a pane opened there; neighbouring rows mostly tell the same;
2. for a key with several slices these answers are put together from slice to slice, which
   gives the open pane with which each slice begins;
3. each slice makes its panes.

Only step 2 sees all slices of a key at once, as a row for each. `panes_of` is steps 1 and 3 for
one slice; the stateful operator of a stream uses it with the open pane as its state.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.workspace import freeze

#: Rows of a slice; a slice has at least `ROWS_PER_START` rows for each start that it tells of, up to a limit.
SLICE_ROWS, ROWS_PER_START, MOST_SLICE_ROWS = 1 << 16, 256, 1 << 22
#: Stands for the time of rows without one: before all others. Half of it is before every real time.
NO_TIME = -(1 << 62)
#: An open pane: the rows in it, none if there is no such pane, and its deadline.
NOTHING = (0, 0)


def jumps(times: np.ndarray, every: int, after: int) -> np.ndarray:
    """For a pane that opens at each row, the row at which the next one may open; past the end if the slice ends first."""
    count = np.arange(len(times)) + every
    return np.minimum(count, np.searchsorted(times, times + after, "left") + np.where(times + after > times[-1:], every, 0))


def entered(head: np.ndarray, rows: int, every: int, open_pane: tuple[int, int]) -> tuple[int | None, bool]:
    """Where the first pane of its own opens in a slice that begins with an open pane; None if it takes all ``rows``.

    Also whether the open pane was ended by its count. ``head`` holds the first times, ``every - 1`` of them suffice.
    """
    held, deadline = open_pane
    if not held:
        return 0, False
    missing = every - held
    before = int(np.searchsorted(head[:missing], deadline, "left"))
    if before < min(missing, rows):
        return before, False
    return (missing, True) if rows >= missing else (None, False)


def left_open(times: np.ndarray, every: int, after: int) -> tuple[np.ndarray, np.ndarray]:
    """The open pane after the slice, as rows and deadlines, for a pane that opens at each of the first ``every`` rows
    or after the last."""
    n = len(times)
    onward = np.append(np.minimum(jumps(times, every, after), n + every), n)
    final = np.where(onward >= n, np.arange(n + 1), onward)  # a row whose pane the slice does not end stays where it is
    while True:
        further = final[final]
        if np.array_equal(further, final):
            break
        final = further
    final = final[: min(every, n) + 1]
    last = np.minimum(final, n - 1)
    ended = (final == n) | (onward[final] == n)
    return np.where(ended, 0, n - final), np.where(ended, 0, times[last] + after)


def panes_of(
    times: np.ndarray, every: int, after: int, open_pane: tuple[int, int] = NOTHING, before: int = 0
) -> tuple[list[tuple[int, str, int]], tuple[int, int]]:
    """The panes that end in a slice of rising times, as ``(count, fired_by, fired_at)``, and the pane left open.

    ``before`` rows came earlier. A row at a deadline or later belongs to the next pane.
    """
    n, made = len(times), []
    if not n:
        return made, open_pane
    at, by_count = entered(times, n, every, open_pane)
    if at is None:
        return made, (open_pane[0] + n, open_pane[1])
    if open_pane[0]:
        made.append((before + at, "count", int(times[at - 1])) if by_count else (before + at, "time", open_pane[1]))
    onward = jumps(times, every, after).tolist()
    while at < n:
        to = onward[at]
        if to > n:
            return made, (n - at, int(times[at]) + after)
        by_count = to == at + every
        made.append((before + to, "count", int(times[to - 1])) if by_count else (before + to, "time", int(times[at]) + after))
        at = to
    return made, NOTHING


def either_panes(
    df: DataFrame, keys: Sequence[str], every: int, after_seconds: float, time: str, name: str = "running_count"
) -> DataFrame:
    """``*keys``, ``running_count``, ``fired_by`` ("count" or "time") and ``fired_at`` of every pane; batch only.

    No keys means one sequence of all rows. The pane that is open at the end is fired by its
    deadline. Rows without a time come first, all at one moment; a pane whose deadline follows
    from them, or that they fill, has no ``fired_at``. Null keys are a key like others, rows of
    equal time may stand in any order, and an empty table has no panes.
    """
    if every < 1 or after_seconds <= 0:
        raise ValueError("every must be at least 1 and after_seconds above 0")
    after = int(after_seconds * 1_000_000)
    inner = [f"k{i}" for i in range(len(keys))]
    rows = df.select(*(F.col(c).alias(k) for c, k in zip(keys, inner)), F.unix_micros(F.col(time).cast("timestamp")).alias("micros"))
    own = F.struct(*inner) if inner else F.struct(F.lit(0))
    slices = _slices(rows.fillna(NO_TIME, "micros"), inner, every).withColumn("key", own)
    several = slices.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    known = _open_panes(slices.join(several, "key", "left_semi").select("key", "first", "times"), every, after)
    # the place of its first row names a slice, whatever the key
    begun = slices.drop("key").join(known.drop("key"), "first", "left")
    begun = begun.fillna(0, ["held", "deadline", "before"]).fillna(True, ["is_last"])
    schema = T.StructType([*(slices.schema[k] for k in inner), *T.StructType.fromDDL("running_count long, fired_by string, fired_at timestamp")])
    panes = begun.mapInArrow(_fire(inner, every, after), schema)
    return panes.select(*(F.col(k).alias(c) for c, k in zip(keys, inner)), F.col("running_count").alias(name), "fired_by", "fired_at")


def _slices(rows: DataFrame, keys: list[str], every: int) -> DataFrame:
    """``*keys, first, times``: the rows of each key in the order of time, in one array or several."""
    once = freeze(rows.withColumn("source", F.spark_partition_id()), "trigger-input")
    placed = once.repartitionByRange(*keys, "micros", "source").sortWithinPartitions(*keys, "micros").drop("source")
    numbered = placed.withColumn("first", F.monotonically_increasing_id())
    most = max(SLICE_ROWS, min(ROWS_PER_START * every, MOST_SLICE_ROWS))
    schema = T.StructType([*(rows.schema[c] for c in keys), *T.StructType.fromDDL("first long, times array<long>")])
    return freeze(numbered.mapInArrow(_pack(keys, most), schema), "trigger-slices")


def _pack(keys: list[str], most: int):
    def cut(table: pa.Table) -> pa.RecordBatch:
        n, changes = table.num_rows, np.zeros(table.num_rows, bool)
        changes[0] = True
        for c in keys:
            codes = pc.dictionary_encode(table.column(c).combine_chunks(), null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            changes[1:] |= codes[1:] != codes[:-1]
        starts = np.flatnonzero(changes)
        times = pa.ListArray.from_arrays(pa.array(np.append(starts, n), pa.int32()), table.column("micros").combine_chunks())
        columns = [table.column(c).combine_chunks().take(pa.array(starts)) for c in [*keys, "first"]]
        return pa.RecordBatch.from_arrays([*columns, times], [*keys, "first", "times"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= most:
                yield cut(pa.Table.from_batches(held))
                held = []
        if held:
            yield cut(pa.Table.from_batches(held))

    return run


def _times(batch: pa.RecordBatch, i: int) -> np.ndarray:
    return batch.column("times")[i].values.to_numpy(zero_copy_only=False)


def _open_panes(slices: DataFrame, every: int, after: int) -> DataFrame:
    """For each slice of keys with several: the pane open at its start, the rows before it, and whether it is the last."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                times = _times(batch, i)
                held, deadlines = left_open(times, every, after)
                changed = np.flatnonzero(np.append(True, (held[1:] != held[:-1]) | (deadlines[1:] != deadlines[:-1])))
                rows.append((len(times), times[: every - 1].tolist(), changed.tolist(), held[changed].tolist(), deadlines[changed].tolist()))
            n, *lists = zip(*rows) if rows else [()] * 5
            made = [pa.array(n, pa.int64()), *(pa.array(x, pa.list_(pa.int64())) for x in lists)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("first"), *made], ["key", "first", "n", "head", "starts", "helds", "deadlines"])

    def follow(group: pa.Table) -> pa.Table:
        group = group.take(pc.sort_indices(group, [("first", "ascending")]))
        open_pane, before, rows = NOTHING, 0, []
        for r in group.drop_columns(["key"]).to_pylist():
            rows.append((*open_pane, before))
            at, _ = entered(np.array(r["head"], np.int64), r["n"], every, open_pane)
            if at is None:
                open_pane = (open_pane[0] + r["n"], open_pane[1])
            else:
                i = int(np.searchsorted(r["starts"], at, "right")) - 1
                open_pane = (r["helds"][i], r["deadlines"][i])
            before += r["n"]
        held, deadline, counted = zip(*rows)
        is_last = [i + 1 == len(rows) for i in range(len(rows))]
        return pa.table({"key": group.column("key"), "first": group.column("first"), "held": held, "deadline": deadline, "before": counted, "is_last": is_last})

    own = slices.schema["key"]
    told = T.StructType([own, *T.StructType.fromDDL("first long, n long, head array<long>, starts array<long>, helds array<long>, deadlines array<long>")])
    known = T.StructType([own, *T.StructType.fromDDL("first long, held long, deadline long, before long, is_last boolean")])
    return slices.mapInArrow(tell, told).groupBy("key").applyInArrow(follow, known)


def _fire(keys: list[str], every: int, after: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, made = [], []
            begun = zip(*(batch.column(c).to_pylist() for c in ("held", "deadline", "before", "is_last")))
            for i, (held, deadline, before, is_last) in enumerate(begun):
                times = _times(batch, i)
                panes, left = panes_of(times, every, after, (held, deadline), before)
                if is_last and left[0]:
                    panes.append((before + len(times), "time", left[1]))
                owners += [i] * len(panes)
                made += panes
            counts, by, at = zip(*made) if made else [()] * 3
            at = [None if t < NO_TIME // 2 else t for t in at]
            columns = [batch.column(c).take(pa.array(owners, pa.int64())) for c in keys]
            columns += [pa.array(counts, pa.int64()), pa.array(by, pa.string()), pa.array(at, pa.timestamp("us", "UTC"))]
            yield pa.RecordBatch.from_arrays(columns, [*keys, "running_count", "fired_by", "fired_at"])

    return run


# Ship this module's worker code inside the task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
