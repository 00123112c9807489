"""Verdicts on urls by nested host and path rules, as a sort-merge range join.

A rule's host is reversed label by label and its path follows, so that ``example.net`` with
``/en/`` becomes ``net.example//en/``. All that the rule fits on that very host lies in one
interval of the sorted keys: the texts that begin with its key. Two such intervals are nested or
apart. A url gets a key for each end of its host that is some rule's host, so subdomains come to
lie in the same intervals.

Rules and urls are sorted by key into slices that tasks sweep one by one, with the rules around
the current place on a stack, the longest on top. A slice starts with the rules that are already
open where it starts: those whose keys its first key begins with. So a rule of any width and a
key of any frequency may span slices, and a task holds no more than one stack.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.workspace import freeze

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULE = "host string, path string, verdict string"
MET = "host string, path string, rule string, verdict string, host_length int"
ROW = ["part", "key", "host", "rule", "verdict", "host_length"]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url, both empty if it is null or has no ``://``.

    The host ends before the first ``/``, ``?`` or ``#`` and has A-Z lower-cased; the path goes on
    from there to the first ``?`` or ``#``.
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(lower_ascii(host), F.lit("")), F.coalesce(path, F.lit(""))


def _reversed(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, "[.]")), ".")


def _key(host: Column, path: Column) -> Column:
    """No host holds a slash, so the first one ends it."""
    return F.concat(_reversed(host), F.lit("/"), path)


def _canonical(rules: DataFrame) -> DataFrame:
    """Each rule once: ``key``, ``own`` (reversed host), ``rule``, ``verdict``, ``host_length``, ``labels``."""
    host, path = lower_ascii(F.coalesce("host", F.lit(""))), F.coalesce("path", F.lit(""))
    return (
        rules.where(F.col("verdict").isNotNull() & ~F.coalesce(F.contains("host", F.lit("/")), F.lit(False)))
        .select(host.alias("host"), path.alias("path"), "verdict")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .select(
            _key(F.col("host"), F.col("path")).alias("key"), _reversed(F.col("host")).alias("own"), F.concat("host", "path").alias("rule"),
            "verdict", F.length("host").alias("host_length"), "host", F.size(F.split("host", "[.]")).alias("labels"),
        )
    )


def _points(urls: DataFrame, rules: DataFrame) -> DataFrame | None:
    """A ``key`` for each distinct host and path and each end of the host that is a rule's host."""
    lengths = sorted(r.labels for r in rules.select("labels").distinct().collect())
    if not lengths:
        return None
    held = F.size(F.split("host", "[.]"))
    ends = F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= held)
    return (
        urls.select("host", "path").distinct()
        .select("host", "path", F.explode(ends).alias("n"))
        .select("host", "path", F.expr("substring_index(host, '.', -n)").alias("end"))
        .join(rules.select(F.col("host").alias("end")).distinct(), "end", "left_semi")
        .select(_key(F.col("end"), F.col("path")).alias("key"), "host")
    )


def _open_at(slices: DataFrame, rules: DataFrame) -> DataFrame:
    """The rules that are open where each slice starts: only prefixes as long as some rule of that host are tried."""
    first = slices.groupBy("part").agg(F.min("key").alias("first")).withColumn("own", F.substring_index("first", "/", 1))
    lengths = rules.groupBy("own").agg(F.collect_set(F.length("key")).alias("lengths"))
    tried = first.join(lengths, "own").select("part", "first", F.explode("lengths").alias("n")).where(F.col("n") <= F.length("first"))
    return tried.select("part", F.expr("substring(first, 1, n)").alias("key")).join(rules, "key")


def _sweep(batches):
    part, around = None, []
    for batch in batches:
        out = []
        for of, key, host, rule, verdict, length in zip(*(batch.column(c).to_pylist() for c in ROW)):
            if of != part:
                part, around = of, []
            while around and not key.startswith(around[-1][0]):
                around.pop()
            if host is None:
                around.append((key, rule, verdict, length))
            elif around:
                out.append((host, key[key.index("/") + 1 :], *around[-1][1:]))
        columns = list(zip(*out)) or [()] * 5
        types = [pa.string()] * 4 + [pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["host", "path", "rule", "verdict", "host_length"])


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` for every row of ``pages``.

    ``rules`` has ``host``, ``path`` and ``verdict``. A rule fits its host and all subdomains where the
    url's path starts with the rule's. The longest fitting rule wins, by the characters of host
    and path together, then by the longer host. A url that no rule fits has a null ``rule`` and the
    verdict ``default``. A null or empty url, or one without ``://``, has an empty host and path.

    A null host or path of a rule is empty; an empty host fits only urls with an empty one. A rule
    with a null verdict or with a slash in its host fits nothing. Of rules that differ in the verdict
    only, the greatest verdict holds, so block before allow. Repeated rows and ids stay, other
    columns are left behind, and an empty table gives no rows.
    """
    host, path = url_parts(pages[url_col].cast("string"))
    urls = pages.select(pages[id_col].alias("page_id"), host.alias("host"), path.alias("path"))
    canonical = freeze(_canonical(rules), "url-rules")
    points = _points(urls, canonical)
    if points is None:
        return urls.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    nothing = F.lit(None).cast("string")
    placed = points.select("key", "host", nothing.alias("rule"), nothing.alias("verdict"), F.lit(0).alias("host_length"))
    known = canonical.select("key", nothing.alias("host"), "rule", "verdict", "host_length")
    keyed = freeze(placed.unionByName(known), "url-keys")
    # the host splits a key that very many hosts have, such as the one of a root path
    slices = freeze(keyed.repartitionByRange("key", "host").withColumn("part", F.spark_partition_id()), "url-slices")
    rows = slices.select(*ROW).unionByName(_open_at(slices, canonical).withColumn("host", nothing).select(*ROW))
    swept = rows.repartition("part").sortWithinPartitions("part", "key", F.col("host").asc_nulls_first()).mapInArrow(_sweep, MET)
    longest = F.struct(F.length("rule").alias("length"), "host_length")
    best = swept.groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), longest).alias("best"))
    judged = urls.join(best, ["host", "path"], "left")
    return judged.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
