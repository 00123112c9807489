"""Top-N kept up on a stream of changing scores, which may fall as well as rise.

For each group the state holds the latest score of every key, the top, and a bound that no key
outside the top exceeds. A batch touches the entries of its own keys only. They and the old top
decide the new top, as long as its last member is not below the bound; when members have fallen
so far that a key outside could have overtaken them, the group's keys are gone through once and
the bound is set anew.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tidemark.session import use_rocksdb_state


def stream_top_n(df: DataFrame, n: int, *, per: Sequence[str], key: str, score: str, seq: str) -> DataFrame:
    """``*per, revision, rank, key, score`` of every ranking that a batch has changed, whole, in append mode.

    The newest ``revision`` of a group is its ranking: of each key's latest score by ``seq`` (equal
    ones: the greater score), the ``n`` greatest; equal scores go by key. ``key`` is text, ``score`` and ``seq``
    are whole numbers; rows without one of the three are left out, as no order places them. A key
    that fell out comes back when others fall below it.

    Keys are cut down to their newest row in every Arrow batch before they are dealt out by group.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    use_rocksdb_state(df.sparkSession)
    groups = [f"p{i}" for i in range(len(per))] or ["all_rows"]
    columns = [F.col(c).alias(g) for c, g in zip(per, groups)] or [F.lit(0).alias("all_rows")]
    rows = df.select(*columns, F.col(key).cast("string").alias("key"), F.col(score).cast("bigint").alias("score"), F.col(seq).cast("bigint").alias("seq"))
    rows = rows.filter("key IS NOT NULL AND score IS NOT NULL AND seq IS NOT NULL")
    own = [rows.schema[g] for g in groups]
    ranked = rows.mapInArrow(_newest_of_batch(groups), rows.schema).groupBy(*groups).transformWithStateInPandas(
        statefulProcessor=Ranking(groups, n),
        outputStructType=T.StructType([*own, *T.StructType.fromDDL("revision long, rank long, key string, score long")]),
        outputMode="append",
        timeMode="None",
    )
    return ranked.select(*(F.col(g).alias(c) for c, g in zip(per, groups)), "revision", "rank", F.col("key").alias(key), F.col("score").alias(score))


def _newest_of_batch(groups: list[str]):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch]).sort_by([("seq", "ascending"), ("score", "ascending")])
            by = table.group_by([*groups, "key"], use_threads=False).aggregate([("score", "last"), ("seq", "last")])
            yield from by.select([*groups, "key", "score_last", "seq_last"]).rename_columns([*groups, "key", "score", "seq"]).to_batches()

    return keep


class Ranking(StatefulProcessor):
    """Per group: the latest score of each key, the top, and the bound on the others."""

    def __init__(self, groups: list[str], n: int):
        self.groups, self.n = groups, n

    def init(self, handle) -> None:
        self.latest = handle.getMapState("latest", "key string", "score bigint, seq bigint")
        self.top = handle.getListState("top", "key string, score bigint")
        self.bound = handle.getValueState("bound", "key string, score bigint")
        self.revision = handle.getValueState("revision", "revision bigint")

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        before = {k: s for k, s in self.top.get()} if self.top.exists() else {}
        changed = self._take_in(rows)
        pool = {**before, **changed}
        ranked = sorted(pool.items(), key=_order)
        bound = self.bound.get() if self.bound.exists() else None
        top, rest = ranked[: self.n], ranked[self.n :]
        if bound is not None and (len(top) < self.n or _order(tuple(bound)) < _order(top[-1])):
            ranked = sorted(((k[0], v[0]) for k, v in self.latest.iterator()), key=_order)
            top, rest = ranked[: self.n], ranked[self.n :]
        elif bound is not None:
            rest.append(tuple(bound))
        if rest:
            self.bound.update(min(rest, key=_order))
        elif self.bound.exists():
            self.bound.clear()
        if top != sorted(before.items(), key=_order):
            self.top.put(top)
            revision = (self.revision.get()[0] if self.revision.exists() else 0) + 1
            self.revision.update((revision,))
            yield self._frame(key, revision, top)

    def _take_in(self, rows) -> dict[str, int]:
        """The new scores of the batch's keys that are newer than those held."""
        newest: dict[str, tuple[int, int]] = {}
        for frame in rows:
            for name, score, seq in zip(frame["key"], frame["score"].tolist(), frame["seq"].tolist()):
                if name not in newest or (seq, score) > newest[name]:
                    newest[name] = (seq, score)
        changed = {}
        for name, (seq, score) in newest.items():
            held = self.latest.getValue((name,)) if self.latest.containsKey((name,)) else None
            if held is None or (seq, score) > (held[1], held[0]):
                self.latest.updateValue((name,), (score, seq))
                changed[name] = score
        return changed

    def _frame(self, key, revision: int, top: list[tuple[str, int]]) -> pd.DataFrame:
        frame = pd.DataFrame([(revision, i + 1, k, s) for i, (k, s) in enumerate(top)], columns=["revision", "rank", "key", "score"])
        for place, (name, value) in enumerate(zip(self.groups, key, strict=True)):
            frame.insert(place, name, value)
        return frame

    def close(self) -> None:
        pass


def _order(entry: tuple[str, int]) -> tuple[int, bytes]:
    return -entry[1], entry[0].encode()


# Ship this module's worker code inside the task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
