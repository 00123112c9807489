"""Connected components over a distributed edge table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.workspace import delete_folder, scratch_path


def connected_components(edges: DataFrame) -> DataFrame:
    """The smallest node each linked node can reach.

    ``edges`` has long columns ``a`` and ``b``; direction, repeats and loops do not matter
    and a null end drops the edge. Returns ``node``, ``component`` for every node with an
    edge to another node.

    Alternates two contractions, each of which hangs the neighbours of a node onto the
    smallest of them, until all components are stars. Both take the minimum with a partial
    aggregate and join it back, so a node with very many neighbours is never gathered: its
    rows may be split like those of any skewed join. Each round is written to the shared
    folder, which cuts the lineage, and the round before is deleted.
    """
    spark = edges.sparkSession
    edges = _towards_smaller(edges.select("a", "b"))
    path = _write(edges, spark)
    while True:
        current = spark.read.parquet(path)
        if not current.take(1) or _all_stars(current):
            break
        following = _write(_small_star(_large_star(current)), spark)
        delete_folder(spark, path)
        path = following
    roots = current.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _write(edges: DataFrame, spark) -> str:
    path = scratch_path(spark, "links")
    edges.distinct().write.parquet(path)
    return path


def _towards_smaller(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _all_stars(edges: DataFrame) -> bool:
    """No node has two smaller neighbours, and no centre has one."""
    centres = edges.select(F.col("b").alias("a")).distinct().withColumn("centre", F.lit(1))
    owned = edges.groupBy("a").agg(F.count("*").alias("n"))
    return not owned.join(centres, "a", "left").where("n > 1 OR centre = 1").take(1)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return _towards_smaller(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _towards_smaller(moved.unionByName(least.withColumnRenamed("m", "b")))


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and the links a[i]-b[i], the smallest node each can reach."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        following = root.copy()
        np.minimum.at(following, root[a], low)
        np.minimum.at(following, root[b], low)
        np.minimum.at(following, a, low)
        np.minimum.at(following, b, low)
        following = following[following]
        if np.array_equal(following, root):
            return root
        root = following
