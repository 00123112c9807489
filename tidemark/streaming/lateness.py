"""Windowed counts on a stream that lose nothing: rows behind the watermark come out beside the counts.

Spark drops a late row before a stateful operator sees it. Here the operator gets every row and
decides by itself: a row whose window the watermark has passed, or that has no time, is put out as
late; others are added to their window. So for any run, rows kept and rows late make up rows read.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tidemark.functions.times import window_bounds
from tidemark.session import use_rocksdb_state
from tidemark.streaming.panes import _count_rows

KEPT, LATE, CLOSED = "kept", "late", "closed"


def stream_window_counts(df: DataFrame, keys: Sequence[str], *, size: str, delay: str, time: str = "publish_ts") -> DataFrame:
    """``window_start, window_end, *keys, kind, rows, score`` in append mode, several rows for a key:

    * ``kept``: a batch added ``rows`` to the key's window, which makes ``score`` so far;
    * ``late``: ``rows`` of a batch came after the watermark, ``delay`` behind the newest row of the
      batches before, had passed the window's end. Rows without a time are late and have no window;
    * ``closed``: the watermark passed the end; ``score`` is final and the window's state is gone.

    ``size`` is a fixed span such as ``10 minutes``. Rows are counted by key in every Arrow batch
    before they are dealt out, so a busy key reaches its task as few rows.
    """
    use_rocksdb_state(df.sparkSession)
    inner = [f"k{i}" for i in range(len(keys))]
    start, end = window_bounds(F.col(time), size)
    rows = df.withWatermark(time, delay).select(
        F.unix_micros(start).alias("start"), F.unix_micros(end).alias("end"), *(F.col(c).alias(k) for c, k in zip(keys, inner))
    )
    grouped = ["start", "end", *inner]
    counted = rows.mapInArrow(_count_rows(grouped), T.StructType([*rows.schema.fields, T.StructField("rows_added", T.LongType())]))
    made = counted.groupBy(*grouped).transformWithStateInPandas(
        statefulProcessor=WindowCounter(grouped),
        outputStructType=T.StructType([*rows.schema.fields, *T.StructType.fromDDL("kind string, rows long, score long")]),
        outputMode="append",
        timeMode="EventTime",
    )
    return made.select(
        F.timestamp_micros("start").alias("window_start"), F.timestamp_micros("end").alias("window_end"),
        *(F.col(k).alias(c) for c, k in zip(keys, inner)), "kind", "rows", "score",
    )


class WindowCounter(StatefulProcessor):
    """Per window and key: the rows so far, until a timer at the window's end."""

    def __init__(self, keys: list[str]):
        self.keys = keys

    def init(self, handle) -> None:
        self.handle = handle
        self.total = handle.getValueState("total", "rows bigint")

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        added = sum(int(frame["rows_added"].sum()) for frame in rows)
        end = key[1]
        if end is None or pd.isna(end) or self._due(end) <= timerValues.getCurrentWatermarkInMs():
            yield self._frame(key, LATE, added, None)
            return
        if not self.total.exists():
            self.handle.registerTimer(self._due(end))
        total = (self.total.get() or (0,))[0] + added
        self.total.update((total,))
        yield self._frame(key, KEPT, added, total)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        if self.total.exists():
            total = self.total.get()[0]
            self.total.clear()
            yield self._frame(key, CLOSED, 0, total)

    def close(self) -> None:
        pass

    def _due(self, end: int) -> int:
        """The window's end in milliseconds; a window ends on a whole one."""
        return int(end) // 1000

    def _frame(self, key, kind: str, rows: int, score: int | None) -> pd.DataFrame:
        row = [None if v is None or v != v else v for v in key]
        return pd.DataFrame([[*row, kind, rows, score]], columns=[*self.keys, "kind", "rows", "score"], dtype=object)


# Ship this module's worker code inside the task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
