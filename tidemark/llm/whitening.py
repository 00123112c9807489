"""Whitened embeddings: components of unit variance without correlation.

Vectors are first put on a grid of whole numbers. Identical ones are one row from then on, with
the number of their copies; a row's weight in the fit is one or that number. Tasks multiply
centred blocks of distinct vectors, and the sums of these products are the covariance, of which
only as many numbers as the square of the dimension come to the driver. Each distinct vector is
projected once and joined back to its copies.

Sums over the corpus are sums of whole numbers and exact; a vector's distance to the mean is
formed from whole numbers before it is rounded to a double.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.workspace import freeze

GRID, OFFSET = 64.0, 1_000_000
#: Grid numbers stay below this, so that their differences fit 64 bits.
LARGEST = float(1 << 62)
#: Bytes of vectors multiplied at once, and shares in which products of tasks are summed first.
BLOCK_BYTES, SHARES = 8 << 20, 64
#: Sums are kept in two halves, so that they stay whole numbers of 64 bits.
HALF = 26
#: A component with less of the whole variance has none that rounding did not make.
LEAST_SHARE = 1e-13


@dataclass
class Model:
    """Fit over the vectors of one length: total weight, sums, and components by falling eigenvalue."""

    n: int
    sums: list[int]
    whole: np.ndarray  # of the mean, so that x - whole is exact
    rest: np.ndarray  # sums - n * whole, below n
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.eigenvalues > 0, self.centred(x) @ self.components.T / np.sqrt(self.eigenvalues), np.nan)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of ``(n x - S)^2``, exact; null where no long holds one."""
        apart = x - self.whole
        size = (np.abs(apart).astype(np.float64) * self.n + self.n).max(axis=1, initial=0)
        small = size * size * x.shape[1] < 2.0**62
        out: list[int | None] = (np.where(small[:, None], apart * self.n - self.rest, 0) ** 2).sum(axis=1).tolist()
        for i in np.flatnonzero(~small).tolist():
            total = sum((int(a) * self.n - int(r)) ** 2 for a, r in zip(apart[i], self.rest))
            out[i] = total if total < 1 << 63 else None
        return out


def grid_vector(vector: Column) -> Column:
    """``floor(64 c) + 1000000`` of each entry; null if one is null, not finite or too large for 64 bits."""
    fine = F.coalesce(F.forall(vector, lambda c: F.abs(c.cast("double")) * F.lit(GRID) < F.lit(LARGEST)), F.lit(False))
    return F.when(fine, F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(GRID)) + F.lit(OFFSET)))


def _blocks(batches, *columns: str):
    """Arrays of the vectors of one length, a bounded number at once, with the other columns beside them."""
    for batch in batches:
        sizes = batch.column("x").value_lengths().to_numpy(zero_copy_only=False)
        flat, ends = batch.column("x").flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes)
        for size in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == size)
            step = max(1, BLOCK_BYTES // 8 // max(size, 1))
            for at in range(0, len(rows), step):
                own = rows[at : at + step]
                x = flat[(ends[own] - size)[:, None] + np.arange(size)]
                yield size, x, [batch.column(c).take(pa.array(own)) for c in columns]


def _weights(column: pa.Array, counted: bool) -> np.ndarray:
    return column.to_numpy().astype(np.int64) if counted else np.ones(len(column), np.int64)


def _sums(distinct: DataFrame, counted: bool) -> dict[int, tuple[int, list[int]]]:
    """By vector length: total weight and the exact sum of each entry."""

    def run(batches):
        totals: dict[int, list] = {}
        for size, x, (copies,) in _blocks(batches, "copies"):
            weight = _weights(copies, counted)
            own = totals.setdefault(size, [0, np.zeros(size, np.int64), np.zeros(size, np.int64)])
            own[0] += int(weight.sum())
            own[1] += weight @ (x >> HALF)
            own[2] += weight @ (x & ((1 << HALF) - 1))
        rows = [(size, i, n, h, low) for size, (n, high, lows) in totals.items() for i, (h, low) in enumerate(zip(high.tolist(), lows.tolist()))]
        columns = list(zip(*rows)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["size", "i", "n", "high", "low"])

    partial = distinct.select("x", "copies").mapInArrow(run, "size long, i long, n long, high long, low long")
    exact = lambda c: F.sum(F.col(c).cast("decimal(20,0)")).alias(c)
    found: dict[int, tuple[int, dict]] = {}
    for r in partial.groupBy("size", "i").agg(F.sum("n").alias("n"), exact("high"), exact("low")).collect():
        found.setdefault(r["size"], (r["n"], {}))[1][r["i"]] = (int(r["high"]) << HALF) + int(r["low"])
    return {size: (n, [sums[i] for i in range(size)]) for size, (n, sums) in found.items()}


def _products(rows: DataFrame, block, shares: int = SHARES) -> dict[int, np.ndarray]:
    """By vector length: the sum over all tasks of the square matrices that ``block(batches)`` yields with it.

    Each matrix travels row by row and is summed in two steps, so that a task holds few of them.
    """

    def run(batches):
        totals: dict[int, np.ndarray] = {}
        for size, product in block(batches):
            totals[size] = totals[size] + product if size in totals else product
        for size, total in totals.items():
            entries = pa.ListArray.from_arrays(pa.array(np.arange(len(total) + 1, dtype=np.int32) * len(total)), pa.array(total.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(total), size)), pa.array(np.arange(len(total))), entries], ["size", "i", "entries"])

    def add(group: pa.Table) -> pa.Table:
        column = group.column("entries").combine_chunks()
        total = column.flatten().to_numpy().reshape(group.num_rows, -1).sum(axis=0)
        return pa.table({"size": group.column("size")[:1], "i": group.column("i")[:1], "entries": pa.array([total.tolist()], pa.list_(pa.float64()))})

    schema = "size long, i long, entries array<double>"
    partial = rows.mapInArrow(run, schema).withColumn("share", F.spark_partition_id() % shares)
    shared = partial.groupBy("size", "i", "share").applyInArrow(add, schema)
    out: dict[int, dict] = {}
    for r in shared.groupBy("size", "i").applyInArrow(add, schema).collect():
        out.setdefault(r["size"], {})[r["i"]] = r["entries"]
    return {size: np.array([own[i] for i in range(len(own))]) for size, own in out.items()}


def fit(distinct: DataFrame, most: int = 16, counted: bool = False) -> dict[int, Model]:
    """A model for each vector length in ``distinct`` (``x`` array of long, ``copies``).

    ``counted`` weighs a vector by its copies, otherwise by one. The covariance is centred before
    it is multiplied and divided by the weight. The driver gets the sums and the covariance, whose
    size is that of the vectors' dimension alone, and keeps the ``most`` largest components.
    """
    models = {}
    for size, (n, sums) in _sums(distinct, counted).items():
        whole = [s // n for s in sums]
        rest = np.array([s - n * w for s, w in zip(sums, whole)], np.int64)
        models[size] = Model(n, sums, np.array(whole, np.int64), rest, *[np.zeros(0)] * 3)

    def block(batches):
        for size, x, (copies,) in _blocks(batches, "copies"):
            y = models[size].centred(x)
            yield size, (y * _weights(copies, counted)[:, None]).T @ y

    for size, product in _products(distinct.select("x", "copies"), block).items():
        model, covariance = models[size], product / models[size].n
        values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
        values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
        trace = float(np.trace(covariance))
        model.components = np.ascontiguousarray(vectors.T)
        model.eigenvalues = np.where(values > LEAST_SHARE * trace, values, 0.0)
        model.explained = model.eigenvalues / trace if trace > 0 else np.zeros(len(values))
    return models


def transform(distinct: DataFrame, models: dict[int, Model]) -> DataFrame:
    """``distinct`` with ``n``, ``deviation`` and ``parts``, an array of ``component, whitened, explained``."""

    def run(batches):
        for size, x, (copies,) in _blocks(batches, "copies"):
            model = models[size]
            values = model.whitened(x)
            held = values.shape[1]
            flat = pa.StructArray.from_arrays(
                [pa.array(np.tile(np.arange(1, held + 1, dtype=np.int32), len(x))), pa.array(values.ravel(), from_pandas=True), pa.array(np.tile(model.explained, len(x)))],
                ["component", "whitened", "explained"],
            )
            parts = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * held), flat)
            vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * size), pa.array(x.ravel()))
            columns = [vectors, copies, pa.array([model.n] * len(x), pa.int64()), pa.array(model.deviations(x), pa.int64()), parts]
            yield pa.RecordBatch.from_arrays(columns, ["x", "copies", "n", "deviation", "parts"])

    schema = "x array<long>, copies long, n long, deviation long, parts array<struct<component:int,whitened:double,explained:double>>"
    return distinct.select("x", "copies").mapInArrow(run, schema)


def identity_errors(made: DataFrame, models: dict[int, Model], counted: bool = False) -> float:
    """The largest entry, apart from the identity, of the covariance of what ``transform`` gave; 0.0 of nothing.

    Components without variance are left out. The whitened values are centred once more by their
    own mean, which rounding alone keeps from zero.
    """

    def block(batches):
        for batch in batches:
            column = batch.column("parts")
            sizes = batch.column("x").value_lengths().to_numpy(zero_copy_only=False)
            flat, held = column.flatten().field("whitened").fill_null(0.0).to_numpy(), column.value_lengths().to_numpy(zero_copy_only=False)
            ends = np.cumsum(held)
            for size in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == size)
                values = flat[(ends[own] - held[own])[:, None] + np.arange(held[own[0]])]
                weight = _weights(batch.column("copies").take(pa.array(own)), counted)
                with_one = np.hstack([values, np.ones((len(own), 1))])
                yield size, (with_one * weight[:, None]).T @ with_one

    worst = 0.0
    for size, product in _products(made.select("x", "copies", "parts"), block).items():
        n, real = models[size].n, models[size].eigenvalues > 0
        mean = product[-1, :-1] / n
        apart = product[:-1, :-1] / n - np.outer(mean, mean) - np.eye(len(mean))
        worst = max(worst, float(np.abs(apart[np.ix_(real, real)]).max(initial=0.0)))
    return worst


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = 16, counted: bool = False) -> DataFrame:
    """``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    Rows whose vector is null, or has an entry that is null, not finite or so large that 64 times
    it needs over 62 bits, are dropped. Each other row has a row for each of the ``most`` largest
    components. ``n`` is the total fit weight: the number of distinct grid vectors, or with
    ``counted`` of all. ``deviation`` sums ``(n x - S)^2`` over the entries, null if no long holds it;
    ``whitened`` is the centred grid vector on the component over the root of the eigenvalue,
    ``explained`` the eigenvalue's share of the variance; ``identity_error`` is one number for the call.

    Vectors of different lengths are fitted and whitened apart. A component without variance
    (fewer distinct vectors than dimensions) has a null ``whitened`` and ``explained`` 0; vectors
    without entries have no component. Repeated rows and ids stay, a null id too; other columns are
    left behind; an empty table gives no rows.
    """
    rows = vectors.select(vectors[id_col].alias("vec_id"), grid_vector(vectors[vector_col]).alias("x")).where(F.size("x") > 0)
    distinct = freeze(rows.groupBy("x").agg(F.count("*").alias("copies")), "whiten-distinct")
    models = fit(distinct, most, counted)
    made = freeze(transform(distinct, models), "whiten-made")
    error = identity_errors(made, models, counted)
    joined = rows.join(made.drop("copies"), "x").select("vec_id", "n", "deviation", F.explode("parts").alias("part"))
    return joined.select(
        "vec_id", "part.component", "n", "deviation", "part.whitened", "part.explained", F.lit(error).alias("identity_error")
    )
