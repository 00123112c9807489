"""Named queries: each takes (spark, folder of tables) and returns flat rows.

Times are given as text and counts as BIGINT, so results compare across engines.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.payload import at_path, variant_state
from tidemark.functions.times import event_time, format_time, pane_timestamp
from tidemark.operators import ranking
from tidemark.operators.comparing import top_n_compared
from tidemark.operators.counts import count_per_window
from tidemark.operators.intake import (
    decode_messages,
    drop_duplicate_messages,
    keep_with_key,
    parse_messages,
    quarantine,
    quarantine_groups,
)
from tidemark.operators.panes import count_panes, fired_panes
from tidemark.operators.shaping import (
    bind_category,
    decode_delivery,
    encode_envelope,
    format_hot_topics,
    routed_counts,
    routed_hot_topics,
)
from tidemark.operators.tables import schema_ddl, schema_string, stream_to_table, write_batch, write_table
from tidemark.operators.triggers import either_panes
from tidemark.plans import trending
from tidemark.schemas import GLOBAL_EVENTS, HOT_TOPICS, MESSAGE, OPEN_MESSAGE
from tidemark.session import prepare
from tidemark.sources.event_records import attributed_messages_from_events, messages_from_events, raw_records_from_events
from tidemark.sources.message_log import append_messages, read_message_log
from tidemark.sources.messages import read_json_lines, read_table, splits, spread
from tidemark.sources.records import project_records, with_attributes
from tidemark.streaming import jobs, sinks
from tidemark.streaming.lateness import CLOSED, KEPT, LATE, stream_window_counts
from tidemark.streaming.panes import stream_count_panes, stream_either_panes
from tidemark.streaming.rankings import stream_top_n
from tidemark.streaming.seen import SeenIds
from tidemark.workspace import child_names, path_exists, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

DAY = "1 day"
TOPIC_WINDOW = ["window_start", "window_end", "topic_key", "topic_name"]
AT_ONCE = {"availableNow": True}
# Spans of time that every registered stream is cut into, and the least files of each.
SLICES, FILES_PER_SLICE = 4, 2
# An idle stream that has not read all its rows for so long will not do so.
STALL_SECONDS = 120.0
EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "props"]


def query(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(prepare(spark), folder)

    QUERIES[function.__name__] = run
    return function


def _messages(spark: SparkSession, folder: str, *keep: str) -> DataFrame:
    return messages_from_events(_events(spark, folder), *keep)


def _events(spark: SparkSession, folder: str) -> DataFrame:
    """Where the table comes in fewer splits than there are cores, its rows are dealt out to them."""
    events = read_table(spark, folder, "events").select(*EVENT_COLUMNS)
    return spread(events, spark.sparkContext.defaultParallelism)


class Replay(NamedTuple):
    """A table as a stream, and how many batches with rows it comes in at least."""

    stream: DataFrame
    batches: int


def _message_replay(spark: SparkSession, folder: str) -> Replay:
    """The messages in the order of time, a batch for each span of time that has any."""
    events = read_table(spark, folder, "events").select(*EVENT_COLUMNS)
    stream, batches = _replay(spark, *_time_slices(events))
    return Replay(messages_from_events(stream), batches)


def _time_slices(events: DataFrame) -> list[DataFrame]:
    """The rows in ``SLICES`` equal spans of time, some of which may be empty; the first has those without a time."""
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    if first is None:
        return [events]
    step = (last - first) / SLICES
    later = [F.when(F.col("ts") >= first + i * step, 1).otherwise(0) for i in range(1, SLICES)]
    return [events.filter(sum(later) == i) for i in range(SLICES)]


def _replay(spark: SparkSession, *slices: DataFrame) -> Replay:
    """Each frame that has rows, written one after the other, as a batch of a file stream.

    A frame is written in as many files as the source has splits for it, two at least.
    """
    path = scratch_path(spark, "slices")
    files = max(FILES_PER_SLICE, -(-splits(slices[0]) // len(slices)))
    written, whole = [], True
    for part in slices:
        if part.isEmpty():
            continue
        time.sleep(0.05)  # files are taken in the order of their times
        part.repartition(files).write.mode("append").parquet(path)
        written.append(len([n for n in child_names(spark, path) if n.startswith("part-")]))
    if not written:
        slices[0].limit(0).write.parquet(path)
    reader = spark.readStream.schema(slices[0].schema).option("maxFilesPerTrigger", files)
    # a frame of very few rows has fewer files, and then the batches are no longer the frames
    aligned = written == [files * (i + 1) for i in range(len(written))]
    stream = reader.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    if cores > files:  # a batch reads only so many files: deal its rows to every core
        stream = stream.repartition(cores)
    return Replay(stream, len(written) if aligned else min(1, len(written)))


def _finish(query, batches: int) -> None:
    """Wait for a stream to end, and make sure that it carried state through so many batches with rows."""
    query.awaitTermination()
    seen = sum(p["numInputRows"] > 0 for p in query.recentProgress)
    if seen < batches:
        raise RuntimeError(f"{seen} batches had rows; {batches} were to be seen")


def _published(spark: SparkSession, path: str) -> DataFrame:
    """The lines published below a folder, ``value``; none if nothing was."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "value string")
    return spark.read.option("recursiveFileLookup", "true").text(path)


def _published_count(spark: SparkSession, path: str) -> int:
    """The highest count published; 0 if none was."""
    values = _published(spark, path).select(F.get_json_object("value", "$.output").cast("bigint").alias("events"))
    return values.agg(F.coalesce(F.max("events"), F.lit(0))).first()[0]


def _daily_mentions(messages: DataFrame, *keep: str) -> DataFrame:
    return trending.with_window(trending.topic_mentions(messages, keep=keep), DAY)


def _with_text_window(df: DataFrame) -> DataFrame:
    return df.withColumns({c: format_time(F.col(c)) for c in ("window_start", "window_end")})


def _with_text_firing(panes: DataFrame) -> DataFrame:
    return panes.withColumn("fired_at", format_time(F.col("fired_at")))


def _ranked_rows(ranked: DataFrame) -> DataFrame:
    rows = ranked.withColumn("record_timestamp", pane_timestamp(F.col("window_end")))
    return _with_text_window(rows)


# --- counts and rankings of topics -------------------------------------------------------


@query
def venue_events_count(spark: SparkSession, folder: str) -> DataFrame:
    return trending.events_count(_messages(spark, folder))


@query
def hot_topics_10min(spark: SparkSession, folder: str) -> DataFrame:
    return _ranked_rows(trending.hot_topics(_messages(spark, folder)))


@query
def hot_topics_1day(spark: SparkSession, folder: str) -> DataFrame:
    return _ranked_rows(trending.hot_topics(_messages(spark, folder), size=DAY))


@query
def hot_topics_strict(spark: SparkSession, folder: str) -> DataFrame:
    """Same result from input that must be wholly well formed."""
    return _ranked_rows(trending.hot_topics(_messages(spark, folder), size=DAY, strict=True))


@query
def hot_topics_event_time(spark: SparkSession, folder: str) -> DataFrame:
    """Windows on the message's own time; publish time is an hour later."""
    late = _messages(spark, folder).withColumn("timestamp", F.expr("timestamp + INTERVAL 1 HOUR"))
    return _ranked_rows(trending.hot_topics(late, size=DAY, time="event"))


@query
def topic_scores(spark: SparkSession, folder: str) -> DataFrame:
    scores = trending.topic_scores(trending.topic_mentions(_messages(spark, folder)))
    return _with_text_window(scores)


@query
def topics_per_country(spark: SparkSession, folder: str) -> DataFrame:
    ranked = trending.hot_topics(_messages(spark, folder), size=DAY, by_country=True)
    return _with_text_window(ranked)


@query
def event_time_windows(spark: SparkSession, folder: str) -> DataFrame:
    fields = T.StructType([MESSAGE["timestamp"]])
    parsed = parse_messages(trending.venue_messages(_messages(spark, folder)), fields)
    timed = parsed.select(event_time(F.col("timestamp")).alias("event_ts"))
    return _with_text_window(count_per_window(timed, time="event_ts", name="events"))


# --- panes -------------------------------------------------------------------------------


@query
def topic_count_panes(spark: SparkSession, folder: str) -> DataFrame:
    return _with_text_window(count_panes(_daily_mentions(_messages(spark, folder)), TOPIC_WINDOW, 5))


@query
def topic_panes_fired(spark: SparkSession, folder: str) -> DataFrame:
    """Each pane with the message that fired it."""
    mentions = _daily_mentions(_messages(spark, folder, "event_id"), "event_id")
    panes = fired_panes(mentions, TOPIC_WINDOW, 5, [F.col("publish_ts"), F.col("event_id")])
    return _with_text_window(panes.drop("publish_ts"))


@query
def hot_topics_from_panes(spark: SparkSession, folder: str) -> DataFrame:
    return _ranked_rows(trending.hot_topics_by_panes(_messages(spark, folder), size=DAY))


@query
def latest_pane_per_topic(spark: SparkSession, folder: str) -> DataFrame:
    """All panes in, the newest of each topic out."""
    panes = count_panes(_daily_mentions(_messages(spark, folder)), TOPIC_WINDOW, 5)
    return _with_text_window(ranking.latest_by_key(panes, TOPIC_WINDOW, "pane"))


@query
def counter_panes(spark: SparkSession, folder: str) -> DataFrame:
    return count_panes(trending.venue_messages(_messages(spark, folder)), [], 2)


@query
def counter_panes_fired(spark: SparkSession, folder: str) -> DataFrame:
    """One global sequence: numbered without any task seeing all of it."""
    kept = trending.venue_messages(_messages(spark, folder, "event_id")).drop("text")
    return fired_panes(kept, [], 2, [F.col("publish_ts"), F.col("event_id")]).drop("publish_ts")


@query
def counter_panes_either(spark: SparkSession, folder: str) -> DataFrame:
    """The counter's panes: two messages, or 30 seconds after the first, whichever is first."""
    kept = trending.venue_messages(_messages(spark, folder)).select("publish_ts")
    return _with_text_firing(either_panes(kept, [], 2, 30, "publish_ts"))


@query
def topic_panes_either(spark: SparkSession, folder: str) -> DataFrame:
    """A topic's panes of a day: five mentions, or an hour after the first."""
    panes = either_panes(_daily_mentions(_messages(spark, folder)), TOPIC_WINDOW, 5, 3600, "publish_ts")
    return _with_text_firing(_with_text_window(panes))


# --- intake ------------------------------------------------------------------------------


@query
def envelope_projection(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_records_from_events(_events(spark, folder))
    records = with_attributes(project_records(raw))
    return records.select(
        "event_id",
        "timestamp",
        "value",
        F.col("attributes.event_id").alias("id_attribute"),
        F.col("attributes.timestamp").alias("time_attribute"),
    )


@query
def parsed_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Every field of every message with a venue; opaque ones as JSON text."""
    parsed = parse_messages(trending.venue_messages(_messages(spark, folder)), MESSAGE)
    return parsed.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        F.col("timestamp").cast("bigint").alias("timestamp"),
        F.col("group.group_country").alias("country"),
        F.to_json("group.group_topics").alias("topics"),
        "response",
        "venue",
    )


@query
def venue_paths(spark: SparkSession, folder: str) -> DataFrame:
    """What the opaque venue of every message holds, and a path into it."""
    parsed = parse_messages(decode_messages(_messages(spark, folder)), T.StructType([OPEN_MESSAGE["event_id"], OPEN_MESSAGE["venue"]]))
    return parsed.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        variant_state(F.col("venue")).alias("venue"),
        at_path(F.col("venue"), "$.venue_id", "bigint").alias("venue_id"),
    )


@query
def dedup_events(spark: SparkSession, folder: str) -> DataFrame:
    """Every third user's messages are delivered again five minutes later."""
    first = _messages(spark, folder, "event_id", "user_id")
    again = first.filter("user_id % 3 = 0").withColumn(
        "timestamp", F.expr("timestamp + INTERVAL 5 MINUTES")
    )
    delivered = decode_messages(first.unionByName(again).drop("user_id"))
    kept = drop_duplicate_messages(keep_with_key(delivered, trending.REQUIRED_KEY))
    return kept.select("event_id", format_time(F.col("publish_ts")).alias("published"))


@query
def quarantined_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Payloads cut short or with bad bytes, by user; whole ones pass."""
    damaged = _messages(spark, folder, "event_id", "user_id").withColumn(
        "value",
        F.when(F.col("user_id") % 5 == 0, F.expr("substring(value, 1, length(value) - 1)"))
        .when(F.col("user_id") % 5 == 1, F.concat("value", F.unhex(F.lit("FF"))))
        .otherwise(F.col("value")),
    )
    return quarantine(decode_messages(damaged)).select(
        "event_id", F.col("text").isNull().cast("bigint").alias("undecodable")
    )


@query
def quarantined_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Groups that are text, have no list, or hold a bad topic, by user; whole ones pass."""
    text = F.col("value").cast("string")
    broken = (
        F.when(F.col("user_id") % 5 == 0, F.regexp_replace(text, r'"group":\{.*\]\}', '"group":"none"'))
        .when(F.col("user_id") % 5 == 1, F.replace(text, F.lit('"group_topics"'), F.lit('"other"')))
        .when(F.col("user_id") % 5 == 2, F.replace(text, F.lit('"group_topics":['), F.lit('"group_topics":[7,')))
        .otherwise(text)
    )
    messages = _messages(spark, folder, "event_id", "user_id").withColumn("value", F.encode(broken, "UTF-8"))
    return quarantine_groups(decode_messages(messages)).select("event_id")


@query
def dedup_by_attribute(spark: SparkSession, folder: str) -> DataFrame:
    """As `dedup_events`, by the id among the attributes, before any payload is parsed."""
    first = attributed_messages_from_events(_events(spark, folder), "user_id")
    again = first.filter("user_id % 3 = 0").withColumn(
        "timestamp", F.expr("timestamp + INTERVAL 5 MINUTES")
    )
    delivered = decode_messages(first.unionByName(again)).withColumn("message_id", F.col("attributes")["event_id"])
    kept = keep_with_key(drop_duplicate_messages(delivered, key="message_id"), trending.REQUIRED_KEY)
    return kept.select(
        F.col("message_id").cast("bigint").alias("event_id"),
        F.col("attributes")["timestamp"].cast("bigint").alias("sent"),
        format_time(F.col("publish_ts")).alias("published"),
    )


@query
def dedup_without_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Every fifth user's messages have lost their id and all stay, however often delivered."""
    first = _messages(spark, folder, "event_id", "user_id")
    delivered = decode_messages(first.unionByName(first)).withColumn(
        "message_id", F.when(F.col("user_id") % 5 != 0, F.col("event_id"))
    )
    kept = drop_duplicate_messages(delivered.drop("text"), key="message_id")
    return kept.groupBy("event_id").agg(F.count("*").alias("times"))


@query
def tapped_messages(spark: SparkSession, folder: str) -> DataFrame:
    """What a tap on the message flow reports after a full pass."""
    seen = Observation()
    kept = trending.venue_messages(_messages(spark, folder))
    sinks.tap(kept, seen, "publish_ts").write.format("noop").mode("overwrite").save()
    report = seen.get
    row = (report["rows"], report["first"], report["last"])
    return spark.createDataFrame([row], "rows bigint, first string, last string")


# --- top-N family ------------------------------------------------------------------------


@query
def top_n_global(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return ranking.largest(orders, 25, "o_totalprice", ties="o_orderkey")


@query
def smallest_n_global(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return ranking.smallest(orders, 25, "o_totalprice", ties="o_orderkey")


@query
def top_n_derived_key(spark: SparkSession, folder: str) -> DataFrame:
    """Order by an expression, and by one with an argument from another table's single row."""
    lines = read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"
    )
    dearest = read_table(spark, folder, "part").agg(F.max("p_retailprice")).scalar()
    gap = F.abs(F.col("l_extendedprice") - dearest)
    return ranking.smallest(lines, 40, gap, ties=["l_orderkey", "l_linenumber"])


@query
def top_n_large(spark: SparkSession, folder: str) -> DataFrame:
    """More rows than Spark's group limit prunes for: ranked without a single task."""
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return ranking.largest(orders, 5000, "o_totalprice", ties="o_orderkey")


@query
def top_n_large_per_key(spark: SparkSession, folder: str) -> DataFrame:
    """Few keys, each with a large share of the rows, and a large n."""
    lines = read_table(spark, folder, "lineitem").select(
        "l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice"
    )
    return ranking.largest_per_key(
        lines, 2000, "l_extendedprice", ["l_returnflag"], ties=["l_orderkey", "l_linenumber"]
    )


@query
def top_n_per_key(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return ranking.largest_per_key(orders, 3, "o_totalprice", ["o_custkey"], ties="o_orderkey")


@query
def smallest_n_per_key(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_extendedprice"
    )
    return ranking.smallest_per_key(
        lines, 3, "l_extendedprice", ["l_partkey"], ties=["l_orderkey", "l_linenumber"]
    )


@query
def top_n_distinct(spark: SparkSession, folder: str) -> DataFrame:
    """Per customer: of the latest order of each priority, the two dearest."""
    orders = read_table(spark, folder, "orders").select(
        "o_custkey", "o_orderpriority", "o_orderkey", "o_orderdate", "o_totalprice"
    )
    ranked = ranking.top_n(
        orders,
        2,
        "o_totalprice",
        per=["o_custkey"],
        distinct_on=["o_orderpriority"],
        seq=["o_orderdate", "o_orderkey"],
        ties="o_orderkey",
    )
    return ranked.drop("o_orderdate")


@query
def top_n_list(spark: SparkSession, folder: str) -> DataFrame:
    """The list form, one best-first array per customer, as text."""
    orders = read_table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    listed = ranking.top_n_list(
        orders,
        3,
        "o_totalprice",
        per=["o_custkey"],
        ties="o_orderkey",
        item=F.col("o_orderkey"),
        name="orders",
    )
    return listed.withColumn("orders", F.concat_ws(",", F.col("orders").cast("array<string>")))


@query
def resorted_list(spark: SparkSession, folder: str) -> DataFrame:
    """Each customer's three dearest orders, put in an order of one's own: by their last digit, then id."""
    orders = read_table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    listed = ranking.top_n_list(
        orders, 3, "o_totalprice", per=["o_custkey"], ties="o_orderkey", item=F.col("o_orderkey"), name="orders"
    )

    def less_than(a, b):
        return (a % 10 < b % 10) | ((a % 10 == b % 10) & (a < b))

    resorted = ranking.resort_list(F.col("orders"), less_than)
    return listed.select("o_custkey", F.concat_ws(",", resorted.cast("array<string>")).alias("orders"))


@query
def top_n_comparator(spark: SparkSession, folder: str) -> DataFrame:
    """Per customer, the three orders whose numbers come first when they are to spell the largest number together."""
    orders = read_table(spark, folder, "orders").select("o_custkey", "o_orderkey")

    def less_than(a: dict, b: dict) -> bool:
        return f"{a['o_orderkey']}{b['o_orderkey']}" < f"{b['o_orderkey']}{a['o_orderkey']}"

    return top_n_compared(orders, 3, less_than, per=["o_custkey"], ties=["o_orderkey"])


@query
def latest_by_key(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"
    )
    latest = ranking.latest_by_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return latest.drop("o_orderdate")


# --- records, envelopes, tables ----------------------------------------------------------


@query
def hot_topics_documents(spark: SparkSession, folder: str) -> DataFrame:
    records = format_hot_topics(trending.hot_topics(_messages(spark, folder)))
    return records.select(
        "timestamp",
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.to_json("topics").alias("topics"),
    )


@query
def hot_topics_messages(spark: SparkSession, folder: str) -> DataFrame:
    return trending.hot_topics_envelopes(trending.hot_topics(_messages(spark, folder)))


@query
def counter_message(spark: SparkSession, folder: str) -> DataFrame:
    return trending.count_envelopes(trending.events_count(_messages(spark, folder)))


@query
def category_envelope_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Both categories published together, delivered as base64, decoded and routed."""
    messages = _messages(spark, folder)
    topics = format_hot_topics(trending.hot_topics(messages, size=DAY))
    published = encode_envelope(bind_category(topics, HOT_TOPICS)).unionByName(
        encode_envelope(bind_category(trending.events_count(messages), GLOBAL_EVENTS, F.col("events")))
    )
    delivered = decode_delivery(
        published.select(F.base64(F.encode("value", "UTF-8")).alias("data"))
    )
    rows = routed_hot_topics(delivered).select(
        F.lit(HOT_TOPICS).alias("category"),
        "timestamp",
        F.col("window.start").alias("window_start"),
        F.posexplode("topics").alias("rank", "topic"),
    ).select(
        "category",
        "timestamp",
        "window_start",
        (F.col("rank") + 1).cast("bigint").alias("rank"),
        "topic.*",
    )
    counted = routed_counts(delivered).select(
        F.lit(GLOBAL_EVENTS).alias("category"), F.col("events").alias("score")
    )
    together = rows.unionByName(counted, allowMissingColumns=True)
    return together.fillna(0, ["timestamp", "rank"])


@query
def table_sink_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    schema = {"c_custkey": "INTEGER", "c_nationkey": "INTEGER", "c_acctbal": "FLOAT"}
    path = scratch_path(spark, "sink")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    write_table(read_table(spark, folder, "customer"), table, schema, path=path)
    spark.sql(f"DROP TABLE {table}")  # the files at its path stay
    stored = spark.read.schema(schema_ddl(schema)).parquet(path)
    return stored.withColumn("declared", F.lit(schema_string(schema)))


@query
def table_batches_once(spark: SparkSession, folder: str) -> DataFrame:
    """The orders appended in a batch for each priority, every batch twice."""
    schema = {"o_orderkey": "INTEGER", "o_totalprice": "FLOAT"}
    path = scratch_path(spark, "batches")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    priorities = sorted(r[0] for r in orders.select("o_orderpriority").distinct().collect())  # five kinds
    for priority in [*priorities, *priorities]:
        write_batch(orders.filter(F.col("o_orderpriority") == priority), table, schema, priority, path=path)
    stored = spark.read.schema(f"{schema_ddl(schema)}, batch string").parquet(path)
    found = spark.table(table).exceptAll(stored).count() + stored.exceptAll(spark.table(table)).count()
    spark.sql(f"DROP TABLE {table}")  # the files at its path stay
    return stored.withColumn("differing", F.lit(found).cast("bigint"))


# --- streams, run over all the input there is --------------------------------------------


@query
def stream_counter(spark: SparkSession, folder: str) -> DataFrame:
    """The last count published by the running counter."""
    out = scratch_path(spark, "counter")
    replay = _message_replay(spark, folder)
    publish = sinks.publish_files(f"{out}/values")
    _finish(jobs.start_counter(replay.stream, publish, checkpoint=f"{out}/state", trigger=AT_ONCE), replay.batches)
    return spark.createDataFrame([(_published_count(spark, f"{out}/values"),)], "events bigint")


def _early_rankings(spark: SparkSession, folder: str, **options) -> DataFrame:
    """Early rankings, as they stand when all input has been seen.

    A finite replay: no watermark is set, and nothing counts as late.
    """
    out = scratch_path(spark, "hot-topics")
    replay = _message_replay(spark, folder)
    running = jobs.start_hot_topics(
        replay.stream,
        sinks.publish_files(f"{out}/values"),
        rankings=f"{out}/rankings",
        checkpoint=f"{out}/state",
        watermark=None,
        trigger=AT_ONCE,
        **options,
    )
    _finish(running, replay.batches)
    current = jobs.rankings_log(spark, f"{out}/rankings").current()
    return _ranked_rows(current.drop("version", "day"))


@query
def stream_hot_topics(spark: SparkSession, folder: str) -> DataFrame:
    return _early_rankings(spark, folder)


@query
def stream_hot_topics_from_panes(spark: SparkSession, folder: str) -> DataFrame:
    """Early rankings of what the count trigger shows, as they stand at the end."""
    return _early_rankings(spark, folder, size=DAY, every=trending.PANE)


@query
def stream_falling_rankings(spark: SparkSession, folder: str) -> DataFrame:
    """Per day, the three topics with the highest latest value, which falls as often as it rises."""
    events, batches = _replay(spark, *_time_slices(read_table(spark, folder, "events").select(*EVENT_COLUMNS)))
    value = F.get_json_object("props", "$.k").cast("bigint")
    values = trending.with_window(events, DAY, "ts").select(
        "window_start", F.concat(F.lit("k"), value % 10).alias("topic_key"), value.alias("score"), F.unix_micros("ts").alias("seq")
    )
    ranked = stream_top_n(values, 3, per=["window_start"], key="topic_key", score="score", seq="seq")
    shown = _run_to_files(ranked, scratch_path(spark, "falling"), batches)
    newest = ranking.top_n(shown, 1, "revision", per=["window_start", "rank"], rank="newest").drop("newest", "revision")
    return newest.withColumn("window_start", format_time(F.col("window_start")))


@query
def stream_store(spark: SparkSession, folder: str) -> DataFrame:
    """Count and rank, publish, deliver, and upsert: the stored tables at the end."""
    out = scratch_path(spark, "store")
    replay = _message_replay(spark, folder)
    publish = {name: sinks.publish_files(f"{out}/values/{name}") for name in ("counter", "hot_topics")}
    started = jobs.start_all(replay.stream, publish, folder=out, watermark=None, size=DAY, trigger=AT_ONCE)
    for running in started.values():
        _finish(running, replay.batches)
    _published(spark, f"{out}/values").limit(0).write.text(f"{out}/values/none")  # the folder to stream from exists
    folders = [f"{out}/values/{name}" for name in publish]
    batches = sum(len(child_names(spark, path)) for path in folders) // 2
    lines = read_json_lines(spark, f"{out}/values", streaming=True, max_files_per_trigger=2)
    store = sinks.ResultStore(spark, f"{out}/tables")
    stored = jobs.start_store(sinks.as_deliveries(lines), store, checkpoint=f"{out}/stored", trigger=AT_ONCE)
    _finish(stored, min(batches, replay.batches))
    records = store.hot_topics.current().select(
        "timestamp",
        F.col("window.start").alias("window_start"),
        F.to_json("topics").alias("topics"),
    )
    stats = store.stats.current().select("events")
    together = records.unionByName(stats, allowMissingColumns=True)
    return together.fillna(0, ["timestamp", "events"])


@query
def stream_store_aside(spark: SparkSession, folder: str) -> DataFrame:
    """Counts delivered one by one, many of them damaged: what is stored, set aside and why."""
    out = scratch_path(spark, "aside")
    events, batches = _replay(spark, *_time_slices(read_table(spark, folder, "events").select(*EVENT_COLUMNS)))
    category = F.when(F.col("user_id") % 6 == 1, F.lit("TOPICS_PER_COUNTRY")).otherwise(F.lit(GLOBAL_EVENTS))
    output = F.when(F.col("user_id") % 6 == 2, F.lit('"many"')).otherwise(F.col("event_id").cast("string"))
    text = F.concat(F.lit('{"category":"'), category, F.lit('","output":'), output, F.when(F.col("user_id") % 6 == 3, F.lit("")).otherwise(F.lit("}")))
    body = F.when(F.col("user_id") % 6 == 4, F.unhex(F.lit("FF"))).otherwise(F.encode(text, "UTF-8"))
    data = F.when(F.col("user_id") % 6 == 5, F.lit("%")).otherwise(F.base64(body)).alias("data")
    store = sinks.ResultStore(spark, f"{out}/tables", strict=False)
    _finish(jobs.start_store(events.select(data, F.col("ts").alias("publish_ts")), store, checkpoint=f"{out}/state", trigger=AT_ONCE), batches)
    aside = store.aside.current().groupBy("reason").agg(F.count("*").alias("value"))
    return aside.unionByName(store.stats.current().select(F.lit("stored").alias("reason"), F.col("events").alias("value")))


@query
def stream_final_hot_topics(spark: SparkSession, folder: str) -> DataFrame:
    """One record per window the watermark has closed."""
    out = scratch_path(spark, "final")
    replay = _message_replay(spark, folder)
    running = jobs.start_final_hot_topics(
        replay.stream,
        sinks.publish_files(f"{out}/values"),
        checkpoint=f"{out}/state",
        watermark="1 hour",
        size=DAY,
        trigger=AT_ONCE,
    )
    _finish(running, replay.batches)
    return _published(spark, f"{out}/values")


@query
def stream_late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Mentions per day and topic that were counted, and that came after their day was closed.

    Every tenth event is held back and comes in a last batch.
    """
    events = read_table(spark, folder, "events").select(*EVENT_COLUMNS)
    held_back = F.coalesce(F.col("event_id") % 10 == 0, F.lit(False))
    replay = _replay(spark, *_time_slices(events.filter(~held_back)), events.filter(held_back))
    mentions = trending.topic_mentions(messages_from_events(replay.stream))
    counts = stream_window_counts(mentions, ["topic_key", "topic_name"], size=DAY, delay="1 hour")
    rows = _run_to_files(counts, scratch_path(spark, "late"), replay.batches).filter(F.col("kind") != CLOSED)
    sums = [F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("rows"))), F.lit(0)).alias(kind) for kind in (KEPT, LATE)]
    return _with_text_window(rows.groupBy(*TOPIC_WINDOW).agg(*sums))


@query
def stream_topic_panes(spark: SparkSession, folder: str) -> DataFrame:
    replay = _message_replay(spark, folder)
    panes = stream_count_panes(_daily_mentions(replay.stream), TOPIC_WINDOW, 5)
    return _with_text_window(_run_to_files(panes, scratch_path(spark, "panes"), replay.batches))


@query
def stream_tapped_windows(spark: SparkSession, folder: str) -> DataFrame:
    """What a tap by window has noted of the message flow, over all batches."""
    out = scratch_path(spark, "tapped")
    replay = _message_replay(spark, folder)
    tap = sinks.WindowTap(spark, f"{out}/tap", size=DAY)
    writer = trending.venue_messages(replay.stream).writeStream.foreachBatch(tap).trigger(**AT_ONCE)
    _finish(writer.option("checkpointLocation", f"{out}/state").start(), replay.batches)
    noted = tap.report().groupBy("window_start", "window_end").agg(F.sum("rows").alias("rows"), F.min("first").alias("first"), F.max("last").alias("last"))
    return _with_text_window(noted).withColumns({c: format_time(F.col(c)) for c in ("first", "last")})


@query
def stream_counter_panes(spark: SparkSession, folder: str) -> DataFrame:
    replay = _message_replay(spark, folder)
    panes = stream_count_panes(trending.venue_messages(replay.stream), [], 2)
    return _run_to_files(panes, scratch_path(spark, "counter-panes"), replay.batches)


@query
def stream_counter_either(spark: SparkSession, folder: str) -> DataFrame:
    """The panes that `counter_panes_either` has up to the newest message."""
    replay = _message_replay(spark, folder)
    kept = trending.venue_messages(replay.stream).select("publish_ts")
    panes = stream_either_panes(kept, [], 2, 30, time="publish_ts")
    return _with_text_firing(_run_to_files(panes, scratch_path(spark, "either-panes"), replay.batches))


@query
def stream_counter_timed(spark: SparkSession, folder: str) -> DataFrame:
    """The counter with a count trigger that is never reached: its timer shows the total."""
    out = scratch_path(spark, "timed")
    running = jobs.start_counter(
        _message_replay(spark, folder).stream,
        sinks.publish_files(f"{out}/values"),
        checkpoint=f"{out}/state",
        every=1 << 40,
        after_seconds=1,
        trigger={"processingTime": "500 milliseconds"},
    )
    total = read_table(spark, folder, "events").count()
    try:
        events = _timed_total(running, total, lambda: _published_count(spark, f"{out}/values"))
    finally:
        running.stop()
    return spark.createDataFrame([(events,)], "events bigint")


def _timed_total(running, total: int, last_count: Callable[[], int], stall: float = STALL_SECONDS) -> int:
    """The count once ``total`` rows are read and all kept ones are in it.

    There is no limit on the time this takes. Only time in which nothing was gained, and in
    which no batch was at work throughout, counts as a stall.
    """
    taken: dict[int, tuple[int, int]] = {}  # rows read by each batch, and those with a venue
    state, ended, idle, looked = None, None, 0.0, time.monotonic()
    while True:
        progress = running.recentProgress
        for p in progress:
            if p["numInputRows"]:
                taken[p["batchId"]] = (p["numInputRows"], p["observedMetrics"]["venue_messages"]["rows"])
        read, kept = map(sum, zip(*taken.values())) if taken else (0, 0)
        if failure := running.exception():
            raise failure
        count = last_count() if read >= total else None
        if read >= total and count == kept:
            return count
        if not running.isActive:
            raise RuntimeError(f"the stream ended after {read} of {total} rows, with a count of {count} of {kept}")
        seen, last, now = (read, kept, count), progress and progress[-1]["timestamp"], time.monotonic()
        if seen != state:
            state, idle = seen, 0.0
        elif last != ended or not running.status["isTriggerActive"]:
            idle += now - looked
        ended, looked = last, now
        if idle > stall:
            raise RuntimeError(f"the stream stalled after {read} of {total} rows, with a count of {count} of {kept}")
        time.sleep(0.5)


@query
def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Messages kept once by id; those of a slice's last hour come again in a batch of their own."""
    batches = []
    for part in _time_slices(read_table(spark, folder, "events").select(*EVENT_COLUMNS)):
        batches.append(part)
        again = part.filter(F.col("ts") > part.agg(F.max("ts")).scalar() - F.expr("INTERVAL 1 HOUR"))
        batches.append(again.withColumn("ts", F.expr("ts + INTERVAL 5 MINUTES")))
    twice = _replay(spark, *batches)
    parsed = parse_messages(trending.venue_messages(messages_from_events(twice.stream)), MESSAGE)
    once = drop_duplicate_messages(parsed, delay="2 hours").select(F.col("event_id").cast("bigint").alias("event_id"))
    return _run_to_files(once, scratch_path(spark, "dedup"), twice.batches)


@query
def stream_dedup_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Messages kept once by id although all of them come again, and again, weeks later."""
    out = scratch_path(spark, "exact")
    slices = _time_slices(read_table(spark, folder, "events").select(*EVENT_COLUMNS))
    again = [part.withColumn("ts", F.expr("ts + INTERVAL 30 DAYS")) for part in slices]
    replay = _replay(spark, *slices, *again, *slices)
    seen = SeenIds(spark, f"{out}/seen", buckets=8, fan=4)

    def step(batch: DataFrame, batch_id: int) -> None:
        new = seen.first_seen(batch, batch_id, "event_id", ["publish_ts"])
        new.select("event_id", format_time(F.col("publish_ts")).alias("published")).write.mode("overwrite").parquet(f"{out}/rows/batch={batch_id}")

    kept = parse_messages(trending.venue_messages(messages_from_events(replay.stream)), T.StructType([MESSAGE["event_id"]]))
    writer = kept.withColumn("event_id", F.col("event_id").cast("bigint")).writeStream.foreachBatch(step).trigger(**AT_ONCE)
    _finish(writer.option("checkpointLocation", f"{out}/state").start(), replay.batches)
    return spark.read.schema("event_id bigint, published string").parquet(f"{out}/rows").select("event_id", "published")


@query
def stream_message_log(spark: SparkSession, folder: str) -> DataFrame:
    """The table appended to a message log span by span, and read by one stream that is started anew after each."""
    out = scratch_path(spark, "log")
    path = out.removeprefix("file://") + "/messages"
    stream = read_message_log(spark, path, streaming=True)
    kept = trending.venue_messages(stream.select("value", "timestamp", "partition", "offset"))
    ids = parse_messages(kept, T.StructType([MESSAGE["event_id"]])).select(F.col("event_id").cast("bigint").alias("event_id"))
    rows = spark.createDataFrame([], ids.schema)
    for part in _time_slices(read_table(spark, folder, "events").select(*EVENT_COLUMNS)):
        append_messages(messages_from_events(part), path, partitions=4, segment_rows=1000)
        rows = _run_to_files(ids, out, 0)
    return rows


@query
def stream_table_sink(spark: SparkSession, folder: str) -> DataFrame:
    """Message ids and countries streamed into a table of a declared schema."""
    out = scratch_path(spark, "stream-sink")
    table = out.rsplit("/", 1)[1].replace("-", "_")
    schema = {"event_id": "INTEGER", "country": "STRING"}
    replay = _message_replay(spark, folder)
    parsed = parse_messages(trending.venue_messages(replay.stream), MESSAGE)
    rows = parsed.select("event_id", F.col("group.group_country").alias("country"))
    _finish(
        stream_to_table(rows, table, schema, checkpoint=f"{out}/state", path=f"{out}/rows", trigger=AT_ONCE), replay.batches
    )
    spark.sql(f"DROP TABLE {table}")  # the files at its path stay
    return spark.read.schema(schema_ddl(schema)).parquet(f"{out}/rows")


def _run_to_files(df: DataFrame, out: str, batches: int) -> DataFrame:
    """Run a stream into Parquet files, and read them."""
    writer = df.writeStream.format("parquet").option("path", f"{out}/rows")
    _finish(writer.option("checkpointLocation", f"{out}/state").trigger(**AT_ONCE).start(), batches)
    return df.sparkSession.read.schema(df.schema).parquet(f"{out}/rows")
