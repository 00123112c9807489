"""Count- and time-triggered accumulating panes on a stream.

The trigger fires for a key after ``every`` new rows, or ``after_seconds`` after the first
row that no pane has shown yet, whichever is first, and then starts over. Each pane carries
the key's whole count so far.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tidemark.operators import triggers
from tidemark.operators.panes import expand_counts
from tidemark.session import use_rocksdb_state


_PROGRESS = "total bigint, pending bigint"


def stream_count_panes(
    df: DataFrame,
    keys: Sequence[str],
    every: int,
    *,
    after_seconds: float | None = None,
    forget_after_seconds: float | None = None,
    latest_only: bool = False,
    name: str = "running_count",
) -> DataFrame:
    """``*keys, running_count, fired_by`` for every pane, in append mode; no keys for one global count.

    ``latest_only`` leaves out panes that a later one of the same key and batch repeats.

    ``forget_after_seconds`` drops the state of a key that long after its last row. With a
    window among the keys, set it to the window's size plus the lateness to allow, so that
    state is kept only for windows that can still grow. Either time setting makes Spark run
    batches without input, so such a query does not end by itself under ``availableNow``.

    Keys are cut down to one row per Arrow batch in the map tasks, so the state operator
    sees a key at most once per batch of rows. It answers with ranges of counts, which are
    turned into panes afterwards, outside the task that holds the key.
    """
    use_rocksdb_state(df.sparkSession)
    given = list(keys)
    keys = given or ["all_rows"]
    keyed = df.select(*given) if given else df.select(F.lit(0).alias("all_rows"))
    counted = keyed.mapInArrow(
        _count_rows(keys), T.StructType([*keyed.schema.fields, _field("rows_added")])
    )
    ranges = T.StructType(
        [
            *keyed.schema.fields,
            _field("first_count"),
            _field("last_count"),
            T.StructField("fired_by", T.StringType()),
        ]
    )
    fired = counted.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=PaneTrigger(keys, every, after_seconds, forget_after_seconds),
        outputStructType=ranges,
        outputMode="append",
        timeMode="ProcessingTime" if after_seconds or forget_after_seconds else "None",
    )
    if latest_only:
        return fired.select(*given, F.col("last_count").alias(name), "fired_by")
    panes = expand_counts(fired, F.col("first_count"), F.col("last_count"), every, name)
    return panes.select(*given, name, "fired_by")


def stream_either_panes(
    df: DataFrame,
    keys: Sequence[str],
    every: int,
    after_seconds: float,
    *,
    time: str,
    delay: str = "0 seconds",
    name: str = "running_count",
) -> DataFrame:
    """`tidemark.operators.triggers.either_panes` on a stream, by the rows' own times.

    A pane whose deadline comes first is fired when the watermark, ``delay`` behind the newest
    row, has passed it. Batches in the order of time give the panes of the batch form, but for the
    one still open. A row that comes later than that is counted in the pane then open, never lost.

    The rows of a key in an Arrow batch travel as one array of times.
    """
    use_rocksdb_state(df.sparkSession)
    inner = [f"k{i}" for i in range(len(keys))] or ["all_rows"]
    columns = [F.col(c).alias(k) for c, k in zip(keys, inner)] or [F.lit(0).alias("all_rows")]
    micros = F.coalesce(F.unix_micros(time), F.lit(triggers.NO_TIME))
    rows = df.withWatermark(time, delay).select(*columns, micros.alias("micros"))
    own = [rows.schema[k] for k in inner]
    packed = rows.mapInArrow(_pack_times(inner), T.StructType([*own, T.StructField("times", T.ArrayType(T.LongType()))]))
    fired = packed.groupBy(*inner).transformWithStateInPandas(
        statefulProcessor=EitherTrigger(inner, every, int(after_seconds * 1_000_000)),
        outputStructType=T.StructType([*own, *T.StructType.fromDDL("running_count long, fired_by string, micros long")]),
        outputMode="append",
        timeMode="EventTime",
    )
    fired_at = F.when(F.col("micros") > triggers.NO_TIME // 2, F.timestamp_micros("micros")).alias("fired_at")
    return fired.select(*(F.col(k).alias(c) for c, k in zip(keys, inner)), F.col("running_count").alias(name), "fired_by", fired_at)


def _pack_times(keys: list[str]):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grouped = pa.Table.from_batches([batch]).group_by(keys).aggregate([("micros", "list")])
            yield from grouped.select([*keys, "micros_list"]).rename_columns([*keys, "times"]).to_batches()

    return pack


class EitherTrigger(StatefulProcessor):
    """Per key: the rows so far, and the open pane with a timer at its deadline."""

    def __init__(self, keys: list[str], every: int, after: int):
        self.keys, self.every, self.after = keys, every, after

    def init(self, handle) -> None:
        self.handle = handle
        self.progress = handle.getValueState("progress", "total bigint, held bigint, deadline bigint")

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        times = np.sort(np.concatenate([np.asarray(t, np.int64) for frame in rows for t in frame["times"]]))
        total, *open_pane = self.progress.get() or (0, *triggers.NOTHING)
        panes, open_pane = triggers.panes_of(times, self.every, self.after, tuple(open_pane), total)
        self.progress.update((total + len(times), *open_pane))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(_millis(timer))
        if open_pane[0]:
            self.handle.registerTimer(self._due(open_pane[1]))
        if panes:
            yield self._frame(key, panes)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        total, held, deadline = self.progress.get() or (0, *triggers.NOTHING)
        if held and self._due(deadline) <= expiredTimerInfo.getExpiryTimeInMs():
            self.progress.update((total, *triggers.NOTHING))
            yield self._frame(key, [(total, "time", deadline)])

    def close(self) -> None:
        pass

    def _due(self, deadline: int) -> int:
        """The first whole millisecond that is not before the deadline; 0 where there is no time."""
        return max(0, -(-deadline // 1000))

    def _frame(self, key, panes: list[tuple[int, str, int]]) -> pd.DataFrame:
        frame = pd.DataFrame(panes, columns=["running_count", "fired_by", "micros"])
        for place, (name, value) in enumerate(zip(self.keys, key, strict=True)):
            frame.insert(place, name, value)
        return frame


def _field(name: str) -> T.StructField:
    return T.StructField(name, T.LongType())


def _count_rows(keys: list[str]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = pa.Table.from_batches([batch]).group_by(keys)
            counts = groups.aggregate([([], "count_all")])
            yield from counts.select([*keys, "count_all"]).rename_columns([*keys, "rows_added"]).to_batches()

    return count


class PaneTrigger(StatefulProcessor):
    """Per key: the count so far, how much of it came after the last pane, and one timer."""

    def __init__(
        self,
        keys: list[str],
        every: int,
        after_seconds: float | None,
        forget_after_seconds: float | None,
    ):
        self.keys = keys
        self.every = every
        self.after_ms = after_seconds and int(after_seconds * 1000)
        self.ttl_ms = forget_after_seconds and int(forget_after_seconds * 1000)

    def init(self, handle) -> None:
        self.handle = handle
        self.progress = handle.getValueState("progress", _PROGRESS, self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        new = sum(int(frame["rows_added"].sum()) for frame in rows)
        total, pending = self.progress.get() or (0, 0)
        fired, left = divmod(pending + new, self.every)
        self.progress.update((total + new, left))
        if self.after_ms is not None:
            self._keep_timer(restart=fired > 0, waiting=left > 0, timers=timerValues)
        if fired:
            first = total + self.every - pending
            yield self._panes(key, first, first + (fired - 1) * self.every, "count")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        total, pending = self.progress.get() or (0, 0)
        if pending:
            self.progress.update((total, 0))
            yield self._panes(key, total, total, "time")

    def close(self) -> None:
        pass

    def _keep_timer(self, restart: bool, waiting: bool, timers) -> None:
        armed = list(self.handle.listTimers())
        if restart:
            for timer in armed:
                self.handle.deleteTimer(_millis(timer))
            armed = []
        if waiting and not armed:
            self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + self.after_ms)

    def _panes(self, key, first: int, last: int, fired_by: str) -> pd.DataFrame:
        row = dict(zip(self.keys, key, strict=True))
        return pd.DataFrame([{**row, "first_count": first, "last_count": last, "fired_by": fired_by}])


def _millis(timer) -> int:
    return timer[0] if isinstance(timer, tuple) else timer


# Ship this module's worker code inside the task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
