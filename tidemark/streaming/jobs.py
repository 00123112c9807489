"""The streaming jobs. Each takes a message stream and starts one query.

The counter and the early rankings show results while data arrives; the final rankings show
each window once. Work inside ``foreachBatch`` is on DataFrames; nothing passes the driver
but the days a batch touched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.times import format_time
from tidemark.operators.counts import WINDOW, count_all
from tidemark.plans.trending import (
    TOP,
    count_envelopes,
    hot_topics_envelopes,
    rank_topics,
    topic_mentions,
    topic_scores,
    venue_messages,
    with_window,
)
from tidemark.schemas import RANKED_TOPIC
from tidemark.session import use_rocksdb_state
from tidemark.streaming.lateness import CLOSED, LATE, stream_window_counts
from tidemark.streaming.panes import stream_count_panes
from tidemark.streaming.sinks import Publisher, ResultStore, tap
from tidemark.streaming.store import ChangeLog

EARLY = "30 seconds"

RANKINGS = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        *RANKED_TOPIC.fields,
        T.StructField("rank", T.LongType()),
        T.StructField("day", T.StringType()),
    ]
)


def _start(df: DataFrame, mode: str, step: Publisher, checkpoint: str, trigger: dict) -> StreamingQuery:
    writer = df.writeStream.outputMode(mode).foreachBatch(step).trigger(**trigger)
    return writer.option("checkpointLocation", checkpoint).start()


def start_counter(
    messages: DataFrame,
    publish: Publisher,
    *,
    checkpoint: str,
    every: int | None = None,
    after_seconds: float | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """The running number of messages with a venue, published after each batch that adds some.

    State is one row, fed by partial counts. With ``every`` (and ``after_seconds``) the count
    is published each time that trigger fires instead; a query with ``after_seconds`` needs a
    processing-time trigger, as it never runs out of batches.
    """
    use_rocksdb_state(messages.sparkSession)
    kept = tap(venue_messages(messages), "venue_messages", "publish_ts")
    if every is None:
        counted, mode = count_all(kept), "update"
    else:
        panes = stream_count_panes(kept, [], every, after_seconds=after_seconds, name="events")
        counted, mode = panes, "append"

    def step(batch: DataFrame, batch_id: int) -> None:
        publish(count_envelopes(batch.filter("events > 0")), batch_id)

    return _start(counted, mode, step, checkpoint, trigger or {"processingTime": EARLY})


def start_hot_topics(
    messages: DataFrame,
    publish: Publisher,
    *,
    rankings: str,
    checkpoint: str,
    n: int = TOP,
    size: str = WINDOW,
    watermark: str | None,
    every: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Early rankings: after each batch, the new record of every window it touched.

    ``watermark`` is how late a message may be; later ones are dropped and counted, see
    `late_rows`. None keeps all state and is for finite replays only. With ``every``, scores
    are those the count trigger shows: a topic's count each time its window gains that many
    mentions. Its state is forgotten once a topic's window has gained nothing for the window's
    size and ``watermark``; such a query does not end by itself under ``availableNow``.

    Scores only grow, so a topic this batch did not touch and that was not ranked before
    cannot be ranked now: the old ranking of the touched windows plus the changed scores
    decides. ``rankings`` is where those rankings are kept, two versions of each day at most.
    """
    use_rocksdb_state(messages.sparkSession)
    keys = ["window_start", "window_end", "topic_key", "topic_name"]
    mentions = topic_mentions(messages)
    if every is None:
        scores, mode = topic_scores(mentions, size=size, watermark=watermark), "update"
    else:
        windowed = with_window(mentions, size)
        memory = None if watermark is None else _seconds(size) + _seconds(watermark)
        scores = stream_count_panes(
            windowed, keys, every, forget_after_seconds=memory, latest_only=True, name="score"
        )
        mode = "append"

    def step(changed: DataFrame, batch_id: int) -> None:
        log = rankings_log(changed.sparkSession, rankings)
        changed = changed.withColumn("day", _day("window_start")).persist()
        try:
            days = log.touched(changed)
            if not days:
                return
            window = ["window_start", "window_end"]
            touched = changed.select(*window).distinct()
            before = log.newest(days, before=batch_id).drop("version")
            old = before.join(touched, window, "left_semi")
            candidates = old.select(*keys, "score").unionByName(changed.select(*keys, "score"))
            best = candidates.groupBy(*keys).agg(F.max("score").alias("score"))
            ranked = rank_topics(best, n).withColumn("day", _day("window_start"))
            others = before.join(touched, window, "left_anti").select(*ranked.columns)
            log.replace(ranked.unionByName(others), batch_id, days)
            written = log.at(days, batch_id).join(touched, window, "left_semi")
            publish(hot_topics_envelopes(written.drop("version", "day")), batch_id)
        finally:
            changed.unpersist()

    return _start(scores, mode, step, checkpoint, trigger or {"processingTime": EARLY})


def start_final_hot_topics(
    messages: DataFrame,
    publish: Publisher,
    *,
    checkpoint: str,
    n: int = TOP,
    size: str = WINDOW,
    watermark: str,
    late: Publisher | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """One record per window, when the watermark has passed its end.

    A closing window leaves the state whole, in one batch, so ranking that batch is exact.

    With ``late``, mentions behind the watermark are not dropped: each batch hands them to it, by
    window and topic with their number (see `tidemark.streaming.lateness`), those without a time
    too; `sinks.store_late` keeps them in a table.
    """
    use_rocksdb_state(messages.sparkSession)
    mentions = topic_mentions(messages)

    def step(closed: DataFrame, batch_id: int) -> None:
        publish(hot_topics_envelopes(rank_topics(closed, n)), batch_id)

    def step_with_late(counts: DataFrame, batch_id: int) -> None:
        counts = counts.persist()
        try:
            late(counts.filter(F.col("kind") == LATE).drop("kind", "score"), batch_id)
            step(counts.filter(F.col("kind") == CLOSED).drop("kind", "rows"), batch_id)
        finally:
            counts.unpersist()

    if late is not None:
        counts = stream_window_counts(mentions, ["topic_key", "topic_name"], size=size, delay=watermark)
        return _start(counts, "append", step_with_late, checkpoint, trigger or {"processingTime": EARLY})
    scores = topic_scores(mentions, size=size, watermark=watermark)
    return _start(scores, "append", step, checkpoint, trigger or {"processingTime": EARLY})


def start_store(
    deliveries: DataFrame, store: ResultStore, *, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Store what the other jobs published: decode, route by category, upsert."""
    return _start(
        deliveries, "append", store.apply, checkpoint, trigger or {"processingTime": EARLY}
    )


def rankings_log(spark, path: str) -> ChangeLog:
    """Early rankings: of each day, the latest ranking of every window."""
    return ChangeLog(spark, path, RANKINGS, ["window_start", "window_end", "rank"], "day")


def late_rows(query: StreamingQuery) -> int:
    """How many rows the query has dropped as late, in the progress reports Spark still keeps."""
    operators = [op for progress in query.recentProgress for op in progress["stateOperators"]]
    return sum(op["numRowsDroppedByWatermark"] for op in operators)


def start_all(
    messages: DataFrame,
    publish: dict[str, Publisher],
    *,
    folder: str,
    watermark: str | None,
    trigger: dict | None = None,
    **topics,
) -> dict[str, StreamingQuery]:
    """The counter and the early rankings over one source, each a query with its own checkpoint.

    ``publish`` names a publisher for ``counter`` and ``hot_topics``; ``folder`` holds their
    state. Each reads the source by itself and parses only what it needs of a message, so one
    can fall behind or be restarted without the other.
    """
    return {
        "counter": start_counter(
            messages, publish["counter"], checkpoint=f"{folder}/counter", trigger=trigger
        ),
        "hot_topics": start_hot_topics(
            messages,
            publish["hot_topics"],
            rankings=f"{folder}/rankings",
            checkpoint=f"{folder}/hot_topics",
            watermark=watermark,
            trigger=trigger,
            **topics,
        ),
    }


def _day(time: str):
    return F.substring(format_time(F.col(time)), 1, 10)


def _seconds(interval: str) -> float:
    """A time span such as ``10 minutes`` in seconds."""
    count, unit = interval.split()
    return float(count) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.removesuffix("s")]
