"""Computing an expensive column once per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(column: Column) -> Column:
    """The same value, to be used as one column of a ``select``.

    Catalyst pushes filters below projections by copying the projected expressions into
    them, and infers filters of its own above ``inline`` and time windows, so a parsed
    column would be parsed again for every test on it. It does not push through a
    generator: as the single element of an exploded array the value is made once.
    """
    return F.explode(F.array(column))
