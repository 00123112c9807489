"""Event time and its formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds added to a pane's time to form the record's id: fixed by the output format.
# A pane's time is the last instant of its window, whose whole second is end - 1.
_PANE_OFFSET = 1000
_LAST_SECOND = 1


def event_time(millis: Column) -> Column:
    """Integer milliseconds (number or digits) to a timestamp with sub-second precision."""
    return F.timestamp_millis(millis.cast("bigint"))


def format_time(ts: Column) -> Column:
    """Whole-second text in UTC, whatever the session's zone.

    Counted from the epoch without a zone: shifting the instant by the zone's offset would go
    wrong in the hours in which clocks change.
    """
    since = F.make_dt_interval(secs=F.unix_seconds(ts).cast("decimal(18,6)"))
    return F.substring((F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since).cast("string"), 1, 19)


def pane_timestamp(window_end: Column) -> Column:
    """Id of a window's record; constant per window."""
    return F.unix_timestamp(window_end) + F.lit(_PANE_OFFSET - _LAST_SECOND).cast("bigint")


def window_bounds(ts: Column, size: str) -> tuple[Column, Column]:
    """Start and end of the epoch-aligned window of a fixed ``size`` that holds a time, null without one.

    Unlike a grouping window this keeps rows without a time.
    """
    micros = F.expr(f"unix_micros(timestamp'1970-01-01 00:00:00Z' + interval {size})")
    start = F.unix_micros(ts) - F.pmod(F.unix_micros(ts), micros)
    return F.timestamp_micros(start), F.timestamp_micros(start + micros)
