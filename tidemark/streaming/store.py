"""Keyed tables with last-write-wins updates, in versions that are seen whole or not at all.

Plain Parquet has no MERGE and no transaction. A batch reads the rows of the parts it touches,
merges its own in, and writes those parts anew into folders that nobody has read or written
before. Nothing refers to them until the batch commits: a commit is one small table that names,
for every part of every table of the store, the folder of its rows, and it comes to be by one
rename. So a reader sees the tables as some commit left them, also while a batch is at work; a
batch that is killed before its rename has changed nothing, and one that is run again after it
does nothing. Folders go when the commits that named them are no longer kept.

Versions are batch ids: a store has one writer, whose checkpoint belongs to it. A batch reads and
writes the parts it touches, which should be small (a day of rankings).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ranking import latest_by_key
from tidemark.workspace import child_names, delete_folder, move_new, path_exists, path_segment

ENTRY = "table string, part string, attempt string"
Entry = tuple[str, str, str]
FEW = 200


class Table(Protocol):
    """What commits need to know of a table."""

    def folder(self, part: str, attempt: str) -> str: ...


class Commits:
    """The versions of a store: which attempt holds each part of each table.

    The newest ``keep`` commits and the folders they name stay, so a reader has the time of
    ``keep - 1`` batches to read what it has opened.
    """

    def __init__(self, spark: SparkSession, path: str, keep: int = 2):
        if keep < 2:
            raise ValueError("keep must be at least 2: a batch that runs again reads the commit before it")
        self.spark = spark
        self.path = path
        self.keep = keep
        self.tables: dict[str, Table] = {}

    def versions(self) -> list[int]:
        names = child_names(self.spark, self.path)
        return sorted(int(n) for n in names if n.isdigit())

    def newest(self, before: int | None = None) -> int | None:
        return max((v for v in self.versions() if before is None or v < before), default=None)

    def done(self, version: int) -> bool:
        """Whether this version, or a later one, is committed."""
        newest = self.newest()
        return newest is not None and newest >= version

    def entries(self, version: int | None) -> DataFrame:
        """``table``, ``part``, ``attempt`` as of a version; nothing of None."""
        if version is None:
            return self.spark.createDataFrame([], ENTRY)
        return self.spark.read.schema(ENTRY).parquet(self._folder(version))

    def commit(self, version: int, changed: Sequence[Entry], dropped: Sequence[Entry] = ()) -> None:
        """Make ``version``: the entries of the version before without the dropped ones, and with the changed ones in their place."""
        if self.done(version):
            return
        new = self._table(changed)
        gone = new.unionByName(self._table(dropped))
        old = self.entries(self.newest()).join(gone, ["table", "part"], "left_anti")
        draft = f"{self.path}/.draft-{uuid.uuid4().hex}"
        old.unionByName(new).coalesce(1).write.parquet(draft)
        move_new(self.spark, draft, self._folder(version))
        self._forget()

    def _forget(self) -> None:
        """Drop commits beyond those kept, and the folders that only they name."""
        versions = self.versions()
        for version in versions[: -self.keep]:
            kept = self.entries(versions[-self.keep])
            for later in versions[1 - self.keep :]:
                kept = kept.unionByName(self.entries(later))
            for table, part, attempt in self.entries(version).join(kept, ["table", "part", "attempt"], "left_anti").collect():
                delete_folder(self.spark, self.tables[table].folder(part, attempt))
            delete_folder(self.spark, self._folder(version))

    def _table(self, entries: Sequence[Entry]) -> DataFrame:
        """Few entries are literals of the plan, which start no Python worker."""
        if not 0 < len(entries) <= FEW:
            return self.spark.createDataFrame(list(entries), ENTRY)
        rows = (F.struct(*(F.lit(v).alias(c) for v, c in zip(entry, ("table", "part", "attempt")))) for entry in entries)
        return self.spark.range(1).select(F.inline(F.array(*rows)))

    def _folder(self, version: int) -> str:
        return f"{self.path}/{version:020d}"


class ChangeLog:
    """One table: its schema, its key, and the column that splits it into parts.

    A table by itself keeps its own commits. Tables given the same ``commits`` and different names
    change together: each stages its rows, then one commit takes the entries of all. Rows whose part
    is null or empty are in the part ``none``.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        part: str,
        *,
        commits: Commits | None = None,
        name: str = "rows",
    ):
        self.spark = spark
        self.path = f"{path}/{name}"
        self.name = name
        self.keys = list(keys)
        self.part = part
        self.commits = commits or Commits(spark, f"{path}/commits")
        self.commits.tables[name] = self
        self.schema = T.StructType([*schema.fields, T.StructField("version", T.LongType())])

    def merge(self, rows: DataFrame, version: int, seq: Sequence[str | Column]) -> None:
        """Upsert one batch's rows: of a key's rows the last by ``seq`` stays, of equal ones the new."""
        if not self.commits.done(version):
            self.commits.commit(version, self.stage(rows, version, seq))

    def stage(self, rows: DataFrame, version: int, seq: Sequence[str | Column]) -> list[Entry]:
        """Write what `merge` would, and leave it to a commit to make it seen."""
        rows = rows.persist()
        try:
            parts = self.touched(rows)
            new = self._typed(rows).withColumn("_new", F.lit(1))
            old = self.newest(parts, before=version).drop("version").withColumn("_new", F.lit(0))
            both = latest_by_key(old.unionByName(new), self.keys, [*seq, "_new"])
            return self._write(both.drop("_new"), version, parts)
        finally:
            rows.unpersist()

    def replace(self, rows: DataFrame, version: int, parts: Sequence[str]) -> None:
        """Put ``rows`` in place of all rows of ``parts``; a part that gets none is empty from then on."""
        if not self.commits.done(version):
            entries = self._write(rows, version, parts)
            written = {part for _, part, _ in entries}
            self.commits.commit(version, entries, [(self.name, part, "") for part in parts if part not in written])

    def put(self, rows: DataFrame, version: int) -> list[Entry]:
        """Write ``rows`` in place of all rows of the parts they have, for a commit to make seen."""
        return self._write(rows, version, self.touched(rows))

    def _write(self, rows: DataFrame, version: int, parts: Sequence[str]) -> list[Entry]:
        """Entries of the parts that got rows. Rebalancing by part keeps files few without forcing a large part into one task."""
        if not parts:
            return []
        attempt = f"{version}-{uuid.uuid4().hex}"
        (
            self._typed(rows)
            .withColumns({"version": F.lit(version).cast("bigint"), "attempt": F.lit(attempt)})
            .hint("rebalance", F.col(self.part))
            .write.mode("append")
            .partitionBy(self.part, "attempt")
            .parquet(self.path)
        )
        return [(self.name, part, attempt) for part in parts if path_exists(self.spark, self.folder(part, attempt))]

    def touched(self, rows: DataFrame) -> list[str]:
        """The parts of a batch's rows."""
        return [row[0] for row in rows.select(self._part(rows)).distinct().collect()]

    def _part(self, rows: DataFrame) -> Column:
        part = rows[self.part].cast("string")
        return F.when(part != "", part).otherwise("none").alias(self.part)

    def versions(self, part: str) -> list[int]:
        """The versions that wrote rows of a part which are still there."""
        names = child_names(self.spark, f"{self.path}/{path_segment(self.spark, self.part, part)}")
        return sorted(int(n.removeprefix("attempt=").split("-")[0]) for n in names if n.startswith("attempt="))

    def newest(self, parts: Sequence[str], before: int | None = None) -> DataFrame:
        """The rows of the named parts as of the newest version, or the newest below ``before``."""
        return self._read(self._named(parts, self.commits.newest(before)))

    def at(self, parts: Sequence[str], version: int) -> DataFrame:
        """The rows of those named parts that a version wrote."""
        known = version if version in self.commits.versions() else None
        return self._read([(p, a) for p, a in self._named(parts, known) if a.startswith(f"{version}-")])

    def current(self, parts: Sequence[str] | None = None) -> DataFrame:
        """The newest row of each key, of all parts unless some are named.

        The commit is joined to the files by their part and attempt, so only files it names are
        read, and the driver goes through no list of parts.
        """
        version = self.commits.newest()
        if parts is not None:
            return self.newest(parts)
        named = self.commits.entries(version).filter(F.col("table") == self.name)
        if version is None or named.isEmpty():
            return self._read([])
        files = self.spark.read.schema(self._stored()).parquet(self.path)
        named = named.select(F.col("part").alias(self.part), "attempt")
        return files.join(named, [self.part, "attempt"], "left_semi").select(*self.schema.names)

    def folder(self, part: str, attempt: str) -> str:
        return f"{self.path}/{path_segment(self.spark, self.part, part)}/attempt={attempt}"

    def _named(self, parts: Sequence[str], version: int | None) -> list[tuple[str, str]]:
        """The attempts that hold the named parts as of a version."""
        wanted = (F.col("table") == self.name) & F.col("part").isin(list(parts))
        return [(r.part, r.attempt) for r in self.commits.entries(version).filter(wanted).collect()]

    def _stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("attempt", T.StringType())])

    def _read(self, named: Sequence[tuple[str, str]]) -> DataFrame:
        if not named:
            nothing = (F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields)
            return self.spark.range(0).select(*nothing)
        reader = self.spark.read.schema(self._stored()).option("basePath", self.path)
        return reader.parquet(*(self.folder(p, a) for p, a in named)).select(*self.schema.names)

    def _typed(self, rows: DataFrame) -> DataFrame:
        fields = [f for f in self.schema.fields if f.name != "version"]
        return rows.select(*(self._part(rows) if f.name == self.part else F.col(f.name).cast(f.dataType).alias(f.name) for f in fields))
