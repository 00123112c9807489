"""A partitioned message log in a shared folder: appended to by jobs, read as a stream by offsets.

A partition is a sequence of messages numbered from 0. It lies in immutable segments, each a
Parquet file in a folder named by the offset of its first message. A segment counts once those
before it are whole, so readers never see a gap, whatever order the files of an append appear in.
Offsets in a stream's checkpoint say what it has read, so a restart neither loses nor repeats.

``partition=3/base=00000000000000001000/part-....parquet`` with columns ``offset, value, micros, attributes``
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tidemark.functions.names import free_names
from tidemark.operators.positions import with_positions

SCHEMA = "value binary, timestamp timestamp, attributes map<string,string>, partition int, offset bigint"
#: Messages of a segment.
SEGMENT_ROWS = 100_000
FORMAT = "message_log"


def read_message_log(spark: SparkSession, path: str, *, streaming: bool = False) -> DataFrame:
    """``value``, ``timestamp`` and ``attributes`` of the messages, with their ``partition`` and ``offset``.

    The folder must be one that pyarrow opens by the same name on every node. A batch of a stream
    takes all there is, with a task for each segment, as Spark does not tell such a source where
    its query stands before it asks for the end. ``availableNow`` ends after one batch.
    """
    spark.dataSource.register(MessageLog)
    return (spark.readStream if streaming else spark.read).format(FORMAT).option("path", path).load()


def append_messages(messages: DataFrame, path: str, *, partitions: int = 8, key: Column | None = None, segment_rows: int = SEGMENT_ROWS) -> None:
    """Append a batch of ``value``, ``timestamp`` and, if there, ``attributes``.

    ``key`` decides the partition, the value itself if it is not given; in a partition messages
    are in the order of time. A partition of any size is numbered and written by many tasks. One
    writer at a time; the number of partitions may only grow.
    """
    spark = messages.sparkSession
    attributes = F.col("attributes") if "attributes" in messages.columns else F.lit(None)
    rows = messages.select(
        F.pmod(F.xxhash64(F.col("value") if key is None else key), F.lit(partitions)).cast("int").alias("partition"),
        F.unix_micros("timestamp").alias("micros"), "value", attributes.cast("map<string,string>").alias("attributes"),
    )
    ends = spark.createDataFrame([(p, end) for p, end in Log(path).ends().items()], "partition int, end bigint")
    (at,) = free_names(rows, "at")
    numbered = with_positions(rows, [F.col("micros")], ["partition"], at).join(ends, "partition", "left")
    first = F.coalesce("end", F.lit(0))
    segment = F.floor((F.col(at) - 1) / segment_rows) * segment_rows
    placed = numbered.select(
        "partition", F.lpad((first + segment).cast("string"), 20, "0").alias("base"), (first + F.col(at) - 1).alias("offset"), "value", "micros", "attributes"
    )
    # a segment is one file: its rows go to one task, and its size is bounded
    segments = placed.repartition("partition", "base").sortWithinPartitions("partition", "base", "offset")
    segments.write.mode("append").partitionBy("partition", "base").parquet(path)


@dataclass
class Segment(InputPartition):
    """The messages ``start`` to ``end`` of one file that begins with ``base``."""

    partition: int
    file: str
    base: int
    start: int
    end: int


class Log:
    """What of a log is whole: its segments, and each partition's end."""

    def __init__(self, path: str):
        self.path = path
        self.sizes: dict[str, int] = {}

    def segments(self) -> dict[int, list[tuple[int, int, str]]]:
        """By partition, ``(base, end, file)`` of the segments without a gap before them."""
        files, root = _opened(self.path)
        found: dict[int, list[tuple[int, str]]] = {}
        for info in files.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            parts = info.path.split("/")
            if info.type == fs.FileType.File and parts[-1].startswith("part-") and parts[-3].startswith("partition=") and not info.path[len(root) :].startswith("/_"):
                found.setdefault(int(parts[-3].removeprefix("partition=")), []).append((int(parts[-2].removeprefix("base=")), info.path))
        out = {}
        for partition, listed in sorted(found.items()):
            listed.sort()
            out[partition], end = [], listed[0][0]
            for base, file in listed:
                if base != end:
                    break
                end += self._rows(files, file)
                out[partition].append((base, end, file))
        return out

    def ends(self) -> dict[int, int]:
        return {p: listed[-1][1] for p, listed in self.segments().items() if listed}

    def _rows(self, files: fs.FileSystem, file: str) -> int:
        """Segments never change, so a footer is read once."""
        if file not in self.sizes:
            with files.open_input_file(file) as opened:
                self.sizes[file] = pq.ParquetFile(opened).metadata.num_rows
        return self.sizes[file]

    def between(self, start: dict[int, int], end: dict[int, int]) -> list[Segment]:
        """What to read, in as many pieces as segments it lies in."""
        return [
            Segment(partition, file, base, max(base, start.get(partition, 0)), min(to, end.get(partition, 0)))
            for partition, listed in self.segments().items()
            for base, to, file in listed
            if max(base, start.get(partition, 0)) < min(to, end.get(partition, 0))
        ]


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    files, root = fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)
    return files, root.rstrip("/")


def _read(path: str, piece: Segment) -> Iterator[pa.RecordBatch]:
    files, _ = _opened(path)
    with files.open_input_file(piece.file) as opened:
        for batch in pq.ParquetFile(opened).iter_batches(8192, columns=["offset", "value", "micros", "attributes"]):
            offset = batch.column("offset")
            batch = batch.filter(pc.and_(pc.greater_equal(offset, piece.start), pc.less(offset, piece.end)))
            if batch.num_rows:
                columns = [
                    batch.column("value"), batch.column("micros").cast(pa.timestamp("us", "UTC")), batch.column("attributes"),
                    pa.array([piece.partition] * batch.num_rows, pa.int32()), batch.column("offset"),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["value", "timestamp", "attributes", "partition", "offset"])


class MessageLog(DataSource):
    """Spark's data source of the name ``message_log``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LogReader:
        return LogReader(self.options)

    def streamReader(self, schema) -> LogStreamReader:  # noqa: N802
        return LogStreamReader(self.options)


class LogReader(DataSourceReader):
    def __init__(self, options):
        self.log = Log(options["path"])

    def partitions(self) -> Sequence[Segment]:
        return self.log.between({}, self.log.ends())

    def read(self, partition: Segment | None) -> Iterator[pa.RecordBatch]:
        """Spark passes None where there is no partition."""
        return iter(()) if partition is None else _read(self.log.path, partition)


class LogStreamReader(DataSourceStreamReader):
    """Offsets are the next message of each partition, by its number as text."""

    def __init__(self, options):
        self.log = Log(options["path"])

    def initialOffset(self) -> dict:  # noqa: N802
        return {}

    def latestOffset(self) -> dict:  # noqa: N802
        return {str(p): end for p, end in self.log.ends().items()}

    def partitions(self, start: dict, end: dict) -> Sequence[Segment]:
        return self.log.between(_numbered(start), _numbered(end))

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        return _read(self.log.path, partition)

    def commit(self, end: dict) -> None:
        """The checkpoint holds what was read, and the log keeps its segments for other readers."""


def _numbered(offsets: dict) -> dict[int, int]:
    return {int(p): at for p, at in offsets.items()}


# Ship this module's worker code inside the task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
