"""Near-duplicate vectors by lattice hashing, verified by cosine.

Several tables each project the unit vectors at random to eight dimensions and decode them to
the nearest point of the E8 lattice, whose cells are rounder than those of any cubic grid of
that dimension. A vector is kept in its own cell and looks into the cells of the lattice points
next nearest to it. Where a vector looks into another's cell, their cosine decides.

A pair that meets in several tables is counted at its first meeting only: every row carries the
cells of all tables, so that is decided on the spot, and no list of pairs is ever made. A cell
returns one row per vector: its links found there and the smallest vector it is joined with.
"""

from __future__ import annotations

from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.graph import connected_components, local_roots
from tidemark.workspace import freeze

DIMENSIONS = 8
#: Production parameters: tables, cells looked into beside the own one, and units per radian.
TABLES, PROBES, SCALE, SEED = 6, 8, 1.0, 20240501
#: Rows of one tile; a fuller cell is cut into tiles that are compared pair by pair.
TILE = 2048


def e8_neighbours() -> np.ndarray:
    """The 240 shortest vectors: two entries of one, or all of a half with an even number negative."""
    whole = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            whole.append(v)
    halves = [np.array(s) / 2 for s in product((1.0, -1.0), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(whole + halves)


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """The nearest integer points with an even sum: where the sum is odd, the entry rounded furthest goes the other way."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(axis=1) % 2)
    rest = x[odd] - near[odd]
    worst = np.abs(rest).argmax(axis=1)
    near[odd, worst] += np.where(rest[np.arange(len(odd)), worst] >= 0, 1, -1)
    return near


def e8_decode(x: np.ndarray) -> np.ndarray:
    """The nearest points of E8, which is the even-sum points and those moved by a half."""
    whole, half = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    closer = ((x - half) ** 2).sum(axis=1) < ((x - whole) ** 2).sum(axis=1)
    return np.where(closer[:, None], half, whole)


def _cell_numbers(points: np.ndarray, table: int) -> np.ndarray:
    """64-bit numbers of lattice points; two cells that share one only cost a comparison."""
    with np.errstate(over="ignore"):
        number = np.full(points.shape[:-1], np.uint64(0x9E3779B97F4A7C15 + table))
        for i in range(DIMENSIONS):
            number = (number ^ (2 * points[..., i]).astype(np.int64).astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            number ^= number >> np.uint64(31)
    return number.view(np.int64)


def cells(units: np.ndarray, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE, seed: int = SEED) -> np.ndarray:
    """For unit vectors, ``[vector, table, 1 + probes]`` cell numbers, each vector's own cell first."""
    around = e8_neighbours()
    out = np.zeros((len(units), tables, 1 + probes), np.int64)
    for t in range(tables):
        rng = np.random.default_rng([seed, t])
        projection = rng.standard_normal((units.shape[1], DIMENSIONS))
        shift = rng.random(DIMENSIONS)
        for at in range(0, len(units), 4096):
            x = units[at : at + 4096] @ projection * scale + shift
            own = e8_decode(x)
            # |x - own - v|^2 differs between neighbours v by -2 (x - own) v alone, as all have one length
            best = np.argsort(-((x - own) @ around.T), axis=1, kind="stable")[:, :probes]
            points = np.concatenate([own[:, None, :], own[:, None, :] + around[best]], axis=1)
            out[at : at + 4096, t] = _cell_numbers(points, t)
    return out


def _usable(vector_col: str):
    """Not null, no null or non-finite component, not zero."""
    v = F.col(vector_col)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


def _hashed(classes: DataFrame, how: dict) -> DataFrame:
    """Each class with ``cells``: for every table its own cell and those it looks into, flat."""

    def run(batches):
        for batch in batches:
            sizes = batch.column("vector").value_lengths().to_numpy(zero_copy_only=False)
            out = np.empty(len(sizes), object)
            flat, ends = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.cumsum(sizes)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                x = flat[(ends[rows] - size)[:, None] + np.arange(size)]
                made = cells(_units(x), **how)
                for i, row in enumerate(rows):
                    out[row] = made[i].ravel()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(out), pa.list_(pa.int64()))], [*batch.schema.names, "cells"])

    return classes.mapInArrow(run, classes.withColumn("cells", F.array().cast("array<long>")).schema)


def _units(x: np.ndarray) -> np.ndarray:
    """Vectors of length one; first scaled by the largest entry, so that squares stay finite and above zero."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _first_meetings(a: np.ndarray, b: np.ndarray, table: int) -> np.ndarray:
    """Whether no earlier table has ``b`` look into ``a``'s cell; cells by ``[row, table, place]``."""
    fresh = np.ones(len(a), bool)
    for t in range(table):
        fresh &= ~(b[:, t] == a[:, t, :1]).any(axis=1)
    return fresh


def link_counts(cell_rows: DataFrame, threshold: float, per_table: int) -> DataFrame:
    """Rows ``node``, ``n_links``, ``joined`` of every tile of every cell.

    ``cell_rows`` has ``label, table, cell, tile_a, tile_b`` and, of each vector there, its id,
    number of copies, whether it lives in the cell, and in which tile it is.
    """

    def compare(group: pa.Table) -> pa.Table:
        table = group.column("table")[0].as_py()
        ids, copies = group.column("node").to_numpy(), group.column("copies").to_numpy()
        vectors = [np.asarray(v, np.float64) for v in group.column("vector").to_pylist()]
        grid = np.array(group.column("cells").to_pylist(), np.int64).reshape(len(ids), -1, per_table)
        lives, tile = group.column("lives").to_numpy(zero_copy_only=False), group.column("tile").to_numpy()
        tile_a, tile_b = group.column("tile_a")[0].as_py(), group.column("tile_b")[0].as_py()
        n_links, ends_a, ends_b = np.zeros(len(ids), np.int64), [], []
        sizes = np.array([len(v) for v in vectors])
        for size in np.unique(sizes):
            owners = np.flatnonzero(lives & (tile == tile_a) & (sizes == size))
            visitors = np.flatnonzero((tile == tile_b) & (sizes == size))
            if not len(owners) or not len(visitors):
                continue
            x, y = (_units(np.stack([vectors[i] for i in rows])) for rows in (owners, visitors))
            for at in range(0, len(owners), 512):
                i, j = np.nonzero(x[at : at + 512] @ y.T >= threshold)
                i, j = owners[at + i], visitors[j]
                smaller = ids[i] < ids[j]
                i, j = i[smaller], j[smaller]
                first = _first_meetings(grid[i], grid[j], table)
                i, j = i[first], j[first]
                n_links += np.bincount(i, weights=copies[j], minlength=len(ids)).astype(np.int64)
                n_links += np.bincount(j, weights=copies[i], minlength=len(ids)).astype(np.int64)
                ends_a.append(i)
                ends_b.append(j)
        root = local_roots(len(ids), np.concatenate([[0], *ends_a]).astype(np.int64), np.concatenate([[0], *ends_b]).astype(np.int64))
        smallest = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(smallest, root, ids)
        linked = n_links > 0
        return pa.table({"node": ids[linked], "n_links": n_links[linked], "joined": smallest[root][linked]})

    return cell_rows.groupBy("label", "table", "cell", "tile_a", "tile_b").applyInArrow(compare, "node long, n_links long, joined long")


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.98,
    tables: int = TABLES,
    probes: int = PROBES,
    scale: float = SCALE,
    seed: int = SEED,
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for every row of ``vectors``.

    Rows with equal labels are linked at a cosine, in double precision, of ``threshold`` or
    more. Vectors with a null label, and those that are null, zero, empty or hold a null or
    non-finite component, link with nothing; so do vectors of different lengths. Equal vectors of
    a label are one class, compared once and counted as often as they occur. Rows repeated under
    one id are rows like others. A row with a null id counts as a link of others, and its
    component is the smallest id there, null if there is none. Other columns are left behind; an
    empty table gives no rows. Pairs below the threshold are never linked; the share of linked
    pairs that are found depends on tables and probes and is measured in the tests.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        vectors[id_col].cast("long").alias("vec_id"),
        F.when(_usable(vector_col), F.col(vector_col)).alias("vector"),
        F.col(label_col).alias("label"),
    ).withColumn("vector", F.when(F.col("label").isNotNull(), F.col("vector")))
    valid = rows.where("vector IS NOT NULL")
    classes = freeze(
        _hashed(
            valid.groupBy("label", "vector").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
            .withColumn("node", F.monotonically_increasing_id()),
            {"tables": tables, "probes": probes, "scale": scale, "seed": seed},
        ),
        "lattice-classes",
    )
    per_table = 1 + probes
    places = classes.select("label", "node", F.posexplode("cells").alias("place", "cell")).select(
        "label", "node", F.floor(F.col("place") / per_table).cast("int").alias("table"), "cell", (F.col("place") % per_table == 0).alias("lives")
    )
    key = ["label", "table", "cell"]
    busy = (
        places.groupBy(*key).agg(F.count("*").alias("n"), F.count(F.when(F.col("lives"), 1)).alias("owners"))
        .where("owners > 0 AND n > 1")
        .withColumn("tiles", F.ceil(F.col("n") / TILE).cast("int")).drop("n", "owners")
    )
    met = (
        places.join(busy, key)
        .withColumn("tile", F.pmod(F.xxhash64("node", "cell"), F.col("tiles")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .withColumn("ends", F.when(F.col("lives"), F.array(F.struct(F.col("tile").alias("a"), F.col("other").alias("b")), F.struct(F.col("other").alias("a"), F.col("tile").alias("b")))).otherwise(F.array(F.struct(F.col("other").alias("a"), F.col("tile").alias("b")))))
        .withColumn("ends", F.explode(F.array_distinct("ends")))
        .select(*key, F.col("ends.a").alias("tile_a"), F.col("ends.b").alias("tile_b"), "node", "lives", "tile")
    )
    rows_met = met.join(classes.select("node", "vector", "cells", "copies"), "node")
    found = freeze(link_counts(rows_met, threshold, per_table), "lattice-links")
    groups = connected_components(found.select(F.col("node").alias("a"), F.col("joined").alias("b")))
    counts = found.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    per_class = (
        classes.select("label", "vector", "node", "least", "copies")
        .join(counts, "node", "left")
        .join(groups, "node", "left")
        .withColumn("n_links", F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1)
        .withColumn("component", F.coalesce("component", "node"))
    )
    smallest = per_class.groupBy("component").agg(F.min("least").alias("component_id"))
    per_class = per_class.join(smallest, "component").select("label", "vector", "n_links", "component_id")
    joined = valid.join(per_class, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("vector IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return joined.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
