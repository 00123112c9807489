"""Mixing sources to target sizes by Pareto order sampling.

Each source gets a target number of words. Its documents are first all taken as often as fits
whole; what is left of the target is a sample without replacement in which a document's
inclusion probability grows with a power of its size. Documents whose probability would be one or
more are certain of one more copy; what they take goes off the rest, whose probabilities are
scaled anew until all are below one. The others are ranked by random odds over inclusion odds,
and the ranking is cut where the words taken come nearest to what is left.

All that a document's copies depend on beside itself is one row of its source: target, scale and
cut. So a document is judged where it lies; only those of the narrow slice of the ranking that
holds the cut are ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.workspace import freeze

WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix-1"
#: The ranking's range is cut into this many slices, and the slice with the cut into as many again.
SLICES = 256


def random_share(id_column: Column, seed: str) -> Column:
    """A number in (0, 1) fixed by seed and id: the first 52 bits of their MD5."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), id_column.cast("string")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2**52))


def targets(sizes: DataFrame, weights: tuple = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row per source with ``source_size`` and ``target`` from rows of ``source``, ``size``.

    Sources in code point order, null last, weigh ``weights`` in turn and divide ``share`` of
    all words. A target is ``min(cap * size, level * weight)``: what the capped sources leave
    goes to the others by weight. Sorted by cap per unit of weight, the first source whose cap
    is not reached fixes the level. Only one row per source is ordered.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    by_cap = Window.orderBy("reached_at", "place").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    levels = (
        per_source.withColumn("place", F.row_number().over(in_order) - 1)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")))
        .withColumn("cap", F.lit(float(cap)) * F.col("source_size"))
        .withColumn("reached_at", F.col("cap") / F.col("weight"))
        .withColumn("rest", F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(by_cap), F.lit(0.0)))
        .withColumn("rest_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_cap), F.lit(0)))
        .withColumn("level", F.col("rest") / F.col("rest_weight"))
    )
    open_at = F.when(F.col("level") <= F.col("reached_at"), F.struct("reached_at", "place", "level"))
    return levels.withColumn("level", F.min(open_at).over(everything)["level"]).select(
        "source", "source_size", F.coalesce(F.least("cap", F.col("level") * F.col("weight")), F.col("cap")).alias("target")
    )


def _cut(rows: DataFrame, column: str, out: str) -> DataFrame:
    """Per source, the first value of ``column`` at which the words so far reach ``left``.

    Words in ``rows`` come on top of ``before``; ``out`` is the value, ``before`` is updated.
    """
    so_far = Window.partitionBy("source").orderBy(column)
    return (
        rows.groupBy("source", column)
        .agg(F.sum("size").alias("words"), F.first("before").alias("before"), F.first("left").alias("left"))
        .withColumn("reached", F.col("before") + F.sum("words").over(so_far))
        .where("reached >= left")
        .groupBy(F.col("source").alias("of"))
        .agg(F.min(F.struct(F.col(column), (F.col("reached") - F.col("words")).alias("before"))).alias("cut"))
        .select("of", F.col(f"cut.{column}").alias(out), F.col("cut.before").alias("before"))
    )


def _affinity(size: Column, size_power: float) -> Column:
    size = size.cast("double")
    return F.sqrt(size) if size_power == 0.5 else F.pow(size, F.lit(size_power))


def _scales(sized: DataFrame, plan: DataFrame, size_power: float) -> DataFrame:
    """``plan`` with ``left`` and ``spread`` of what is not certain, and ``open``, its largest affinity.

    From the largest affinity down, one whose documents would have probability one or more, given
    that all larger ones are certain, is certain; the first that would not ends the search. A row
    for each source and size is ordered.
    """
    per_size = (
        sized.where("size > 0").withColumn("affinity", _affinity(F.col("size"), size_power))
        .groupBy("source", "affinity").agg(F.sum("size").alias("words"))
    )
    down = Window.partitionBy("of").orderBy(F.desc("affinity"))
    larger, smaller = down.rowsBetween(Window.unboundedPreceding, -1), down.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    tried = (
        per_size.join(plan.where("left > 0").select("of", "left"), F.col("source").eqNullSafe(F.col("of")))
        .withColumn("left", F.col("left") - F.coalesce(F.sum("words").over(larger), F.lit(0)))
        .withColumn("spread", F.sum(F.col("affinity") * F.col("words")).over(smaller))
        .where(F.col("left") * F.col("affinity") < F.col("spread"))
    )
    scales = tried.groupBy("of").agg(F.max_by(F.struct("left", "spread", F.col("affinity").alias("open")), "affinity").alias("scale"))
    found = scales.select(F.col("of").alias("scale_of"), "scale.*")
    return plan.drop("left").join(found, F.col("of").eqNullSafe(F.col("scale_of")), "left").drop("scale_of")


def _placed(rows: DataFrame, size_power: float, seed: str) -> DataFrame:
    """Rows of ``doc_id, size`` and their source's ``more, left, spread, open`` with ``certain``, ``odds`` and ``fine``, the slice of the ranking."""
    affinity = _affinity(F.col("size"), size_power)
    taken = (F.col("size") > 0) & F.col("more")
    chance = F.when(taken & (affinity <= F.col("open")), F.col("left") * affinity / F.col("spread"))
    share = random_share(F.col("doc_id"), seed)
    odds = (share / (1 - share)) / (chance / (1 - chance))
    return rows.withColumn("certain", F.coalesce(taken & (F.col("open").isNull() | (affinity > F.col("open"))), F.lit(False))).withColumn("odds", odds).withColumn(
        "fine", F.floor(F.col("odds") / (1 + F.col("odds")) * SLICES * SLICES)
    )


def _sizes(docs: DataFrame, text_col: str) -> Column:
    return F.coalesce(F.regexp_count(docs[text_col].cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


class Mix:
    """The sizes of all documents, frozen, and per source what its documents are judged by."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: tuple, share: float, cap: float, size_power: float, seed: str):
        self.size_power, self.seed = size_power, seed
        sized = freeze(
            docs.select(docs[id_col].alias("doc_id"), docs[source_col].alias("source"), _sizes(docs, text_col).alias("size")), "mix-sizes"
        )
        plan = (
            targets(sized, weights, share, cap).withColumnRenamed("source", "of")
            .withColumn("whole", F.coalesce(F.floor(F.col("target") / F.nullif("source_size", F.lit(0))), F.lit(0)))
            .withColumn("left", F.col("target") - F.col("whole") * F.col("source_size"))
            .withColumn("more", F.col("left") > 0)
        )
        plan = freeze(_scales(sized, freeze(plan, "mix-targets"), size_power), "mix-plan")
        self.ranked = freeze(_placed(sized.join(plan, F.col("source").eqNullSafe(F.col("of"))).drop("of"), size_power, seed), "mix-ranked")
        drawn = self.ranked.where("odds IS NOT NULL").withColumn("before", F.lit(0).cast("long")).withColumn("slice", F.floor(F.col("fine") / SLICES))
        coarse = _cut(drawn, "slice", "at_slice")
        near = drawn.drop("before").join(coarse, F.col("source").eqNullSafe(F.col("of"))).where("slice = at_slice").drop("of")
        cuts = _cut(near, "fine", "at_fine").withColumnRenamed("of", "cut_of")
        self.plan = freeze(plan.join(cuts, F.col("of").eqNullSafe(F.col("cut_of")), "left").drop("cut_of"), "mix-cuts")

    def settled(self, rows: DataFrame) -> DataFrame:
        """Placed rows with ``drawn``; null where the cut's own slice decides."""
        return rows.withColumn(
            "drawn",
            F.when(F.col("odds").isNull(), F.col("certain")).when(F.col("at_fine").isNull(), True).when(F.col("fine") != F.col("at_fine"), F.col("fine") < F.col("at_fine")),
        )

    def edge(self) -> DataFrame:
        """``doc_id, source, size, drawn`` of the documents in the cut's slice, ordered there."""
        cuts = self.plan.where("at_fine IS NOT NULL").select("of", "at_fine", "before")
        near = self.ranked.join(cuts, F.col("source").eqNullSafe(F.col("of")) & (F.col("fine") == F.col("at_fine"))).where("odds IS NOT NULL")
        order = Window.partitionBy("source").orderBy("odds", F.col("doc_id").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return near.withColumn("drawn", F.col("before") + F.sum("size").over(order) - F.col("size") / 2 <= F.col("left"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    size_power: float = 0.5,
    seed: str = SEED,
) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target`` and ``copies`` for every row of ``docs``.

    ``size`` is the number of words of the text (null: 0) and ``copies`` how often it is taken,
    at most ``cap`` rounded up. A source's copies times sizes miss its target by at most half
    of the size of the document at the cut. Documents without words are never taken in the
    sampled part. Rows repeated under one id get the same random number and are ranked beside
    each other; null sources are one source; other columns are left behind; an empty table
    gives no rows. The same rows, seed and parameters give the same result on any partitioning.

    No source is gathered: the cut is found from word counts of slices of the ranking, then of
    slices of the slice that holds it, and only the documents in one of those are ordered.
    """
    made = Mix(docs, id_col, text_col, source_col, weights, share, cap, size_power, seed)
    cuts = made.plan.select("of", "at_fine")
    settled = made.settled(made.ranked.join(cuts, F.col("source").eqNullSafe(F.col("of")), "left")).where("drawn IS NOT NULL")
    both = settled.select("doc_id", "size", "source_size", "target", "whole", "drawn").unionByName(
        made.edge().select("doc_id", "size", "source_size", "target", "whole", "drawn")
    )
    return both.select("doc_id", "size", "source_size", "target", (F.col("whole") + F.col("drawn").cast("long")).alias("copies"))


def digest(mixed: DataFrame) -> DataFrame:
    """Words taken instead of copies."""
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def repeat_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    size_power: float = 0.5,
    seed: str = SEED,
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, columns as they were.

    Rows repeated under one id with texts of one size are taken equally often: at the cut, the
    least that one of them is. Each row is judged in place by its source's row of the plan, so
    texts are not moved; only rows in the slice with the cut are joined by id.
    """
    made = Mix(docs, id_col, text_col, source_col, weights, share, cap, size_power, seed)
    held = F.struct(*(docs[c] for c in docs.columns)).alias("row")
    own = docs.select(held, docs[id_col].alias("doc_id"), docs[source_col].alias("source"), _sizes(docs, text_col).alias("size"))
    plan = made.plan.select("of", "whole", "left", "spread", "open", "more", "at_fine")
    placed = made.settled(_placed(own.join(plan, F.col("source").eqNullSafe(F.col("of"))), size_power, seed))
    edge = made.edge().groupBy(F.col("doc_id").alias("edge_id"), F.col("size").alias("edge_size")).agg(F.min("drawn").alias("edge_drawn"))
    same = F.col("doc_id").eqNullSafe(F.col("edge_id")) & (F.col("size") == F.col("edge_size"))
    at_edge = placed.where("drawn IS NULL").drop("drawn").join(edge, same).withColumnRenamed("edge_drawn", "drawn")
    both = placed.where("drawn IS NOT NULL").select("row", "whole", "drawn").unionByName(at_edge.select("row", "whole", "drawn"))
    copies = (F.col("whole") + F.col("drawn").cast("long")).cast("int")
    return both.where(copies > 0).select("row", F.explode(F.array_repeat(F.lit(0), copies))).select("row.*")
