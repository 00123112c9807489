"""Licence notices by ordered signature rules, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import id_and_text
from tidemark.llm.license_rules import parse, prefilter

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases that always count, whatever other rules say.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
CONFIDENCE = {1: 0.6, 2: 0.8, 3: 1.0}


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _places(text: Column, pattern: Column) -> Column:
    """``(start, end)`` in words of the pattern's matches in a text of single-spaced words.

    Splitting by the pattern gives what lies between the matches; each piece's spaces are the
    words passed.
    """
    pieces = F.split(text, pattern, F.lit(-1))
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def add(so_far: Column, step: Column) -> Column:
        begin = so_far["at"] + _spaces(step["piece"])
        inner = _spaces(step["match"])
        return F.struct(
            (begin + inner).alias("at"),
            F.concat(so_far["out"], F.array(F.struct(begin.alias("start"), (begin + inner + 1).alias("end")))).alias("out"),
        )

    steps = F.arrays_zip(F.slice(pieces, 1, F.size(matches)).alias("piece"), matches.alias("match"))
    return F.aggregate(steps, start, add, lambda done: done["out"])


def _labelled(places: Column, label: str) -> Column:
    return F.transform(
        places, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), F.lit(label).alias("label"))
    )


def _detections(words: Column, gates: Column) -> Column:
    """Matches of every rule whose gate is among ``gates``, sorted so that no match comes after one that it contains."""
    rules = F.array(
        *[
            F.struct(
                F.lit(order).alias("order"), F.lit(label).alias("label"), F.lit(priority).alias("priority"),
                F.lit(gate).alias("gate"), F.lit(pattern).alias("pattern"),
            )
            for order, label, priority, gate, pattern in parse()
        ]
    )
    tried = F.filter(rules, lambda rule: F.array_contains(gates, rule["gate"]))
    found = F.flatten(
        F.transform(
            tried,
            lambda rule: F.transform(
                _places(words, rule["pattern"]),
                lambda m: F.struct(
                    m["start"].alias("start"), (-m["end"]).alias("minus_end"), (-rule["priority"]).alias("minus_priority"),
                    rule["order"].alias("order"), rule["label"].alias("label"),
                ),
            ),
        )
    )
    return F.array_sort(found)


def _resolved(found: Column) -> Column:
    """Leave out matches inside an equal or higher priority's match that comes before.

    Sorted by start, longest first, an earlier match contains a later one exactly if it ends
    no sooner, so the furthest end of each priority level decides.
    """
    span = "array<struct<start:int,end:int,priority:int,label:string>>"
    start = F.struct(*[F.lit(-1).alias(f"reach{p}") for p in CONFIDENCE], F.array().cast(span).alias("out"))

    def add(so_far: Column, m: Column) -> Column:
        end, priority = -m["minus_end"], -m["minus_priority"]
        covered = F.greatest(*[F.when(priority <= p, so_far[f"reach{p}"]).otherwise(-1) for p in CONFIDENCE]) >= end
        kept = F.array(F.struct(m["start"].alias("start"), end.alias("end"), priority.alias("priority"), m["label"].alias("label")))
        return F.struct(
            *[F.when(priority == p, F.greatest(so_far[f"reach{p}"], end)).otherwise(so_far[f"reach{p}"]).alias(f"reach{p}") for p in CONFIDENCE],
            F.when(covered, so_far["out"]).otherwise(F.concat(so_far["out"], kept)).alias("out"),
        )

    return F.aggregate(found, start, add, lambda done: done["out"])


def license_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``base`` and ``spans`` for every row.

    ``spans`` are the detections left after suppression, as (start, end, priority, label) in
    words, end exclusive; ``base`` are all places of the base phrases, as (start, end, label).
    Texts are lower-cased whole: letters outside A-Z whose lower case is in a-z occur in no phrase.
    Null and empty texts have no words and no spans. Repeated rows are each scanned, columns
    other than the two named are left behind, and an empty table gives no rows.
    """
    words, gates = F.col("words"), F.col("gates")
    pattern = prefilter(sorted({gate for _, _, _, gate, _ in parse()}))
    none = F.array()
    base = F.concat(
        *[
            F.when(F.contains(words, F.lit(phrase)), _labelled(_places(words, F.lit(f"(?<![^ ]){phrase}(?![^ ])")), label))
            .otherwise(none.cast("array<struct<start:int,end:int,label:string>>"))
            for phrase, label in BASE.items()
        ]
    )
    return (
        id_and_text(docs, id_col, text_col)
        .select("doc_id", F.trim(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), SEPARATOR, " ")).alias("words"))
        .select(
            "doc_id",
            F.when(words == "", 0).otherwise(_spaces(words) + 1).cast("long").alias("n_words"),
            words,
            F.regexp_extract_all(words, F.lit(pattern), F.lit(1)).alias("gates"),
        )
        .withColumn("found", F.when(F.size(gates) > 0, _detections(words, gates)))
        .select(
            "doc_id",
            "n_words",
            F.when(F.size(gates) > 0, base).otherwise(none.cast("array<struct<start:int,end:int,label:string>>")).alias("base"),
            F.when(F.size("found") > 0, _resolved(F.col("found")))
            .otherwise(none.cast("array<struct<start:int,end:int,priority:int,label:string>>"))
            .alias("spans"),
        )
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts and first and last places of the base phrases, labels, and the best confidence."""
    listed = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    starts = F.transform("base", lambda m: m["start"].cast("long"))
    best = F.array_max(F.transform("spans", lambda m: m["priority"]))
    score = F.coalesce(*[F.when(best == p, F.lit(c)) for p, c in CONFIDENCE.items()], F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        listed(F.col("base.label")).alias("base_labels"),
        listed(F.concat(F.col("base.label"), F.col("spans.label"))).alias("labels"),
        score.alias("score"),
    )
