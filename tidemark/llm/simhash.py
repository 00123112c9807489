"""Near-duplicate documents by SimHash: 64-bit fingerprints that differ in few bits.

Fingerprints are compared exactly, tile against tile, with exclusive-or and bit counts. A
tile holds the fingerprints with the same population count in each of four 16-bit lanes.
Each differing bit moves one lane's count by one, so a pair of tiles whose counts differ by
more than the radius in total cannot hold a link and is never formed.
"""

from __future__ import annotations

from itertools import product, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import free_name, id_and_text, per_batch, text_bytes
from tidemark.llm.graph import connected_components, local_roots
from tidemark.workspace import freeze

LANES, LANE_BITS, BASE = 4, 16, 32
#: Fingerprints in a block; larger tiles are cut into several.
BLOCK = 4096


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """A-Z lower-cased, words between ASCII white space, runs of ``shingle`` words with repeats.

    Each run is hashed with XXH64 (seed 42); a bit is set if it is set in over half the
    hashes. Fewer words count as one run; no words give zero.
    """
    runs = word_runs(text, shingle)
    if not runs:
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(runs), 1 << 16):
        part = runs[at : at + (1 << 16)]
        counts += bit_counts(np.fromiter(map(xxhash.xxh64_intdigest, part, repeat(42)), "<u8", len(part)))
    return _over_half(counts, len(runs))


def word_runs(text: bytes, shingle: int) -> list[bytes]:
    words = text.lower().split()
    if len(words) < shingle:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    parts = (hashes[at : at + (1 << 16)] for at in range(0, len(hashes), 1 << 16))
    return _over_half(sum(map(bit_counts, parts)), len(hashes))


def _over_half(counts: np.ndarray, n: int) -> int:
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``doc_id``, ``fp`` (the fingerprint's bits as a signed long). A null text is empty."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = np.array([fingerprint(t, shingle) for t in text_bytes(batch.column("text"))], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made.view(np.int64))], ["doc_id", "fp"])

    narrow = id_and_text(docs, id_col, text_col)
    return per_batch(narrow, step, f"doc_id {narrow.schema['doc_id'].dataType.simpleString()}, fp long", "text")


def _lane_counts(fp):
    return [F.bit_count(F.shiftrightunsigned(fp, LANE_BITS * i).bitwiseAND(F.lit((1 << LANE_BITS) - 1))) for i in range(LANES)]


def _offsets(radius: int) -> list[int]:
    """Differences of tile keys within the radius, one of each pair of opposite ones."""
    steps = [s for s in product(range(-radius, radius + 1), repeat=LANES) if sum(map(abs, s)) <= radius]
    keys = sorted(sum(x * BASE**i for i, x in enumerate(s)) for s in steps)
    return [k for k in keys if k >= 0]


def blocks(distinct: DataFrame) -> DataFrame:
    """Distinct ``fp`` packed as ``tile``, ``part``, ``fps``: at most a few thousand a row."""
    lanes = sum((c.cast("long") + F.lit(8)) * F.lit(BASE**i) for i, c in enumerate(_lane_counts(F.col("fp"))))
    tiled = distinct.select("fp", lanes.alias("tile"))
    sizes = tiled.groupBy("tile").agg(F.count("*").alias("n"))
    parts = F.pmod(F.xxhash64("fp"), F.ceil(F.col("n") / BLOCK))
    return (
        tiled.join(sizes, "tile")
        .withColumn("part", parts)
        .groupBy("tile", "part")
        .agg(F.collect_list("fp").alias("fps"))
    )


def close_pairs(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in two blocks whose fingerprints differ in at most ``radius`` bits."""
    a, b = [], []
    rows = max(1, (1 << 20) // max(1, len(right)))
    for at in range(0, len(left), rows):
        i, j = np.nonzero(np.bitwise_count(left[at : at + rows, None] ^ right[None, :]) <= radius)
        a.append(i + at)
        b.append(j)
    return np.concatenate(a), np.concatenate(b)


def links(distinct: DataFrame, radius: int = 3) -> DataFrame:
    """Edges ``a``, ``b`` between fingerprints that join the same ones as all links do.

    Every pair within the radius is found; from each pair of blocks only a forest over its
    linked fingerprints is returned, so the rows grow with the fingerprints, not with pairs.
    """
    if radius >= 8:
        raise ValueError("radius must be below 8")
    packed = freeze(blocks(distinct), "simhash-blocks")
    left = packed.select(
        F.explode(F.array(*[F.lit(k).cast("long") for k in _offsets(radius)])).alias("k"), "tile", "part", "fps"
    ).select((F.col("tile") + F.col("k")).alias("tile"), "k", F.col("part").alias("left_part"), F.col("fps").alias("left"))
    right = packed.select("tile", "part", F.col("fps").alias("right"))
    met = left.join(right, "tile").where("k <> 0 OR left_part <= part").select("left", "right")

    def compare(batches):
        for batch in batches:
            a, b = [], []
            lefts, rights = batch.column("left"), batch.column("right")
            for row in range(batch.num_rows):
                x, y = (c[row].values.to_numpy(zero_copy_only=False) for c in (lefts, rights))
                i, j = close_pairs(x.view(np.uint64), y.view(np.uint64), radius)
                differ = x[i] != y[j]
                if not differ.any():
                    continue
                ends = np.concatenate([x[i[differ]], y[j[differ]]])
                nodes, at = np.unique(ends, return_inverse=True)
                half = len(at) // 2
                root = local_roots(len(nodes), at[:half], at[half:])
                keep = root != np.arange(len(nodes))
                a.append(nodes[keep])
                b.append(nodes[root[keep]])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    return met.mapInArrow(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3
) -> DataFrame:
    """Every row's ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``.

    ``component_id`` is the smallest id reachable over links, the row's own included. Copies
    share a fingerprint and are compared once. A null text is empty, an empty one has
    fingerprint zero and is linked like any other; rows with a null id take part but are never
    the smallest, and rows repeated under one id stay. An empty table gives no rows.
    """
    prints = freeze(fingerprints(docs, id_col, text_col, shingle), "simhash")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    groups = connected_components(links(distinct.select("fp"), radius))
    grouped = distinct.join(groups, distinct.fp == groups.node, "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    smallest = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    per_print = grouped.join(smallest, "component").select("fp", "component_id")
    return prints.join(per_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """The rows of ``docs`` that have the smallest id of their group, columns as they were.

    Rows repeated under one id are one document, of which one row stays; rows with a null
    id all stay.
    """
    groups = near_duplicates(docs, id_col, text_col, shingle, radius)
    name, times = free_name(docs, "kept_id"), free_name(docs, "kept_n")
    kept = freeze(
        groups.where("doc_id = component_id").groupBy(F.col("doc_id").alias(name)).agg(F.count("*").alias(times)),
        "simhash-kept",
    )
    same = F.col(id_col) == F.col(name)
    # the ids grow with the rows, so they are merged with them at every size
    single = docs.join(kept.where(F.col(times) == 1).hint("merge"), same, "left_semi")
    repeated = docs.join(kept.where(F.col(times) > 1), same, "left_semi").dropDuplicates([id_col])
    nameless = docs.where(F.col(id_col).isNull())
    return single.unionByName(repeated).unionByName(nameless)
