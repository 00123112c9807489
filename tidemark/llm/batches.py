"""Helpers for tasks that work on Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Bytes of text handled at once inside a task; a longer single text is handled alone.
SLICE_BYTES = 4 << 20


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows whose ``column`` (string or binary) holds about ``most`` bytes."""
    for batch in batches:
        offsets = _offsets(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = start + 1
            while stop < batch.num_rows and offsets[stop + 1] - offsets[start] <= most:
                stop += 1
            yield batch.slice(start, stop - start)
            start = stop


def _offsets(array: pa.Array) -> list[int]:
    lengths = pc.fill_null(pc.binary_length(array), 0)
    out = [0]
    for n in lengths.to_pylist():
        out.append(out[-1] + n)
    return out


def text_bytes(array: pa.Array) -> list[bytes]:
    """The texts as UTF-8 bytes; null is empty."""
    return [b"" if x is None else x for x in array.cast(pa.binary()).to_pylist()]


def texts(array: pa.Array) -> list[str]:
    """The texts; null is empty."""
    return ["" if x is None else x for x in array.to_pylist()]


def per_batch(
    df: DataFrame,
    step: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: str,
    text: str,
) -> DataFrame:
    """Run ``step`` over slices of ``df`` bounded by the bytes in column ``text``."""

    def run(batches):
        for batch in slices(batches, text):
            yield step(batch)

    return df.mapInArrow(run, schema)


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Just the two columns, under the names ``doc_id`` and ``text``."""
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))


def arrow_type(kind: str) -> pa.DataType:
    """The Arrow type of a Spark type named as in ``simpleString``; for the driver."""
    return to_arrow_type(T.DataType.fromDDL(kind))


def free_name(frame: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``frame`` has it in any case."""
    taken = {c.lower() for c in frame.columns}
    while name in taken:
        name = f"_{name}"
    return name


def in_fold(id_column: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; an id that is null is in none."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % folds == fold, F.lit(False))
