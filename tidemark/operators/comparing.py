"""Top-N under a free comparator, for orders that no column expression gives.

``less_than(a, b)`` gets two rows as dicts and may compare them in any way that orders all rows
(two rows of which neither is less are equal). Python compares the rows, so use it only where
`tidemark.operators.ranking` cannot express the order.

Each map task keeps the best rows of a key and sends on those alone. They are merged in a tree:
shares of the tasks first, as many as there are shuffle partitions, then ever fewer shares until
one is left. Merging goes through rows sorted by key, so a task holds no more than a few times
``n`` rows at once however many a key has.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from functools import cmp_to_key

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.functions.names import free_names

LessThan = Callable[[dict, dict], bool]

#: Rows of all keys that a map task holds at most; with more it sends on what it has and starts anew.
MOST_HELD = 100_000
#: Shares that one share of the next round takes in.
FAN_IN = 64


def top_n_compared(
    df: DataFrame,
    n: int,
    less_than: LessThan,
    *,
    per: Sequence[str] = (),
    reverse: bool = False,
    ties: Sequence[str] = (),
    rank: str = "rank",
) -> DataFrame:
    """The ``n`` greatest rows under ``less_than`` (least, when ``reverse``), in each ``per`` group if given.

    ``ties`` columns order equal rows, smallest first and nulls last; without them their order is
    any. ``rank`` is the place from 1; a column of that name is replaced. Null keys are a group
    like others; an empty table gives no rows. Batch only.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    df = df.drop(rank)
    (share,) = free_names(df, "_share")
    compare = _comparison(less_than, reverse, list(ties))
    shares = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    best = df.mapInArrow(_best_of_task(list(per), n, compare), df.schema).withColumn(share, F.spark_partition_id() % shares)
    while shares > 1:
        merged = _by_group(best, [*per, share]).mapInArrow(_best_of_groups([*per, share], n, compare), best.schema)
        shares = -(-shares // FAN_IN)
        best = merged.withColumn(share, F.col(share) % shares)
    ranked = T.StructType([*df.schema.fields, T.StructField(rank, T.LongType())])
    return _by_group(best.drop(share), per).mapInArrow(_best_of_groups(list(per), n, compare, to_arrow_schema(ranked), rank), ranked)


def _by_group(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of a group one after the other in one task."""
    return df.repartition(*keys).sortWithinPartitions(*keys) if keys else df.coalesce(1)


def _comparison(less_than: LessThan, reverse: bool, ties: list[str]):
    before, after = (-1, 1) if reverse else (1, -1)

    def compare(a: dict, b: dict) -> int:
        if less_than(a, b):
            return before
        if less_than(b, a):
            return after
        for c in ties:
            x, y = (a[c] is None, a[c]), (b[c] is None, b[c])
            if x != y:
                return -1 if x < y else 1
        return 0

    return compare


def _key(row: dict, keys: list[str]) -> tuple:
    return tuple(repr(row[c]) if isinstance(row[c], (list, dict)) else row[c] for c in keys)


def _best_of_task(keys: list[str], n: int, compare):
    """Runs over the rows as they come; each key's list is cut when it is twice too long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[dict]] = {}
        size, schema, order = 0, None, cmp_to_key(compare)
        for batch in batches:
            schema = batch.schema
            for row in batch.to_pylist():
                rows = held.setdefault(_key(row, keys), [])
                rows.append(row)
                size += 1
                if len(rows) >= 2 * n + 16:
                    size -= len(rows) - n
                    rows.sort(key=order)
                    del rows[n:]
                if size >= MOST_HELD + 2 * n:
                    yield _cut(held, n, order, schema)
                    held, size = {}, 0
        if held:
            yield _cut(held, n, order, schema)

    return run


def _cut(held: dict[tuple, list[dict]], n: int, order, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([row for rows in held.values() for row in sorted(rows, key=order)[:n]], schema)


def _best_of_groups(keys: list[str], n: int, compare, schema: pa.Schema | None = None, rank: str | None = None):
    """The best rows of each run of equal keys, with their places if ``rank`` is named."""

    def finished(rows: list[dict]) -> list[dict]:
        best = sorted(rows, key=cmp_to_key(compare))[:n]
        return best if rank is None else [row | {rank: i + 1} for i, row in enumerate(best)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows, kind = None, [], schema
        for batch in batches:
            kind, done = schema or batch.schema, []
            for row in batch.to_pylist():
                key = _key(row, keys)
                if key != current:
                    done += finished(rows)
                    current, rows = key, []
                rows.append(row)
                if len(rows) >= 2 * n + 16:
                    rows.sort(key=cmp_to_key(compare))
                    del rows[n:]
            if done:
                yield pa.RecordBatch.from_pylist(done, kind)
        if rows:
            yield pa.RecordBatch.from_pylist(finished(rows), kind)

    return run


# Ship this module's worker code inside the task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
