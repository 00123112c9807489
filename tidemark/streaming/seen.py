"""De-duplication of a stream without a horizon: an index of all ids that ever came.

The index consists of runs. A run holds the ids that were new in a batch, split by hash into
buckets, and for each bucket a Bloom filter. A batch reads the filters of the buckets its ids fall
into, and then, of those runs and buckets whose filter knows one of them, the ids themselves, so
what it reads is in proportion to the batch and the number of runs. Every ``fan`` runs of a level
are written together as one run of the next, which keeps them few: each id is rewritten once a
level. A batch's new run and what it replaces change by one commit.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.names import free_names
from tidemark.operators.ranking import first_by_key
from tidemark.streaming.store import Commits, Entry
from tidemark.workspace import child_names, freeze

#: Bits of a filter for each id, and how many of them an id sets: about one in 2,000 unknown ids is taken for known.
BITS, PROBES = 16, 8
RUN = "part string, bloom binary, ids array<string>"


class SeenIds:
    """All ids of a stream, kept at ``path``.

    ``buckets`` is fixed when the index begins; choose it so that a bucket of all ids together
    stays within some hundred thousand. ``files_read`` tells how many filters and id files the
    last batch read.
    """

    name = "ids"

    def __init__(self, spark: SparkSession, path: str, *, buckets: int = 256, fan: int = 8):
        self.spark, self.path, self.buckets, self.fan = spark, path, buckets, fan
        self.commits = Commits(spark, f"{path}/commits")
        self.commits.tables[self.name] = self
        self.files_read = (0, 0)

    def folder(self, part: str, attempt: str) -> str:
        """Of a bucket of a run, which the part names as ``level-batch-bucket``."""
        return f"{self.path}/runs/{attempt}/bucket={part.split('-')[2]}"

    def first_seen(self, batch: DataFrame, version: int, key: str, order: Sequence[str | Column]) -> DataFrame:
        """The rows of a batch whose id no earlier batch had, of each id the first by ``order``; all rows without an id.

        The ids count as seen from then on. A batch that is run again gives the same rows.
        """
        bucket, nameless, seen_id = free_names(batch, "_bucket", "_nameless", "_seen_id")
        known = self.commits.newest(before=version)
        rows = batch.withColumn(nameless, F.when(F.col(key).isNull(), F.monotonically_increasing_id()))
        rows = first_by_key(rows, [key, nameless], list(order)).drop(nameless)
        hashed = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(self.buckets)).cast("int")
        rows = freeze(rows.withColumn(bucket, F.when(F.col(key).isNotNull(), hashed)), "seen-rows")
        ids = rows.filter(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("id"), F.col(bucket).alias("bucket"))
        old = self._known(ids, known)
        if old is not None:
            new = rows.join(old.withColumnRenamed("id", seen_id), F.col(key).cast("string") == F.col(seen_id), "left_anti")
            ids = ids.join(old, "id", "left_anti")
        else:
            new = rows
        new = freeze(new.drop(bucket), "seen-new")
        if not self.commits.done(version):
            self._commit(ids, version, known)
        return new

    def _known(self, ids: DataFrame, version: int | None) -> DataFrame | None:
        """Of the runs of a version, the ids that may be among these: those where a filter knows one. None if there are none."""
        asked = freeze(ids.groupBy("bucket").agg(F.collect_list("id").alias("asked")), "seen-asked")
        touched = {str(r.bucket) for r in asked.select("bucket").collect()}
        runs = [e for e in self._entries(version) if e[1].split("-")[2] in touched]
        self.files_read = (len(runs), 0)
        if not runs:
            return None
        filters = self._read(runs).select("part", "bloom", F.split("part", "-")[2].cast("int").alias("bucket"))
        hits = {r.part for r in filters.join(asked, "bucket").mapInArrow(_hits, "part string").collect()}
        hit = [e for e in runs if e[1] in hits]
        self.files_read = (len(runs), len(hit))
        if not hit:
            return None
        found = self._read(hit).select(F.explode("ids").alias("id"))
        return found.join(ids.select("id"), "id", "left_semi").distinct()

    def _read(self, entries: Sequence[Entry]) -> DataFrame:
        return self.spark.read.schema(RUN).parquet(*(self.folder(part, attempt) for _, part, attempt in entries))

    def _entries(self, version: int | None) -> list[Entry]:
        """One for each run and bucket, few thousand in all as runs are merged."""
        return [tuple(r) for r in self.commits.entries(version).collect()]

    def _commit(self, ids: DataFrame, version: int, known: int | None) -> None:
        entries, level, merged = self._entries(known), 0, []
        while True:  # a level that is full goes into the next one together with the new ids
            peers = [e for e in entries if e[1].startswith(f"{level}-")]
            if len({e[1].split("-")[1] for e in peers}) < self.fan - 1:
                break
            merged += peers
            level += 1
        frame = ids.select("bucket", "id")
        if merged:
            frame = frame.unionByName(self._read(merged).select(F.split("part", "-")[2].cast("int").alias("bucket"), F.explode("ids").alias("id")))
        attempt = f"{version}-{uuid.uuid4().hex}"
        part = F.concat(F.lit(f"{level}-{version}-"), F.col("bucket").cast("string"))
        run = frame.groupBy("bucket").applyInArrow(_pack, "bucket int, bloom binary, ids array<string>").withColumn("part", part)
        run.write.partitionBy("bucket").parquet(f"{self.path}/runs/{attempt}")
        written = [n.removeprefix("bucket=") for n in child_names(self.spark, f"{self.path}/runs/{attempt}") if n.startswith("bucket=")]
        self.commits.commit(version, [(self.name, f"{level}-{version}-{b}", attempt) for b in written], merged)


def _bits(hashes: np.ndarray, size: int) -> np.ndarray:
    """The bits that each hash sets in a filter of ``size`` bits, by two halves of it."""
    h = hashes.astype(np.int64).view(np.uint64)
    first, step = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return (first[:, None] + np.arange(PROBES, dtype=np.uint64) * step[:, None]) % np.uint64(size)


def _hash(ids: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(i) for i in ids), np.uint64, len(ids)).view(np.int64)


def _pack(group: pa.Table) -> pa.Table:
    """A run's bucket in one row, which a reader of the filter alone need not read whole."""
    ids = sorted(group.column("id").to_pylist())
    bits = np.zeros(max(64, BITS * len(ids)), np.uint8)
    bits[_bits(_hash(ids), len(bits)).ravel()] = 1
    return pa.table({"bucket": group.column("bucket")[:1], "bloom": pa.array([np.packbits(bits).tobytes()]), "ids": pa.array([ids], pa.list_(pa.string()))})


def _hits(batches):
    """The parts whose filter knows one of the ids asked for."""
    for batch in batches:
        found = []
        for part, bloom, ids in zip(*(batch.column(c).to_pylist() for c in ("part", "bloom", "asked"))):
            bits = np.unpackbits(np.frombuffer(bloom, np.uint8))
            if bits[_bits(_hash(ids), len(bits))].all(axis=1).any():
                found.append(part)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["part"])


# Ship this module's worker code inside the task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
