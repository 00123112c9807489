"""Publishing envelopes, watching a stream, and storing what was published."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import format_time, window_bounds
from tidemark.operators.ranking import latest_by_key
from tidemark.operators.shaping import decode_delivery, examine_deliveries, routed_counts, routed_hot_topics
from tidemark.schemas import HOT_TOPICS_OUTPUT
from tidemark.streaming.store import ChangeLog, Commits, Entry
from tidemark.workspace import path_exists

#: Envelopes in one published file.
LINES_PER_FILE = 100_000

Publisher = Callable[[DataFrame, int], None]

STORED_TOPICS = T.StructType(
    [
        *HOT_TOPICS_OUTPUT.fields,
        T.StructField("mentions", T.LongType()),
        T.StructField("publish_ts", T.TimestampType()),
        T.StructField("last_updated", T.TimestampType()),
        T.StructField("day", T.StringType()),
    ]
)
STORED_STATS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("events", T.LongType()),
        T.StructField("publish_ts", T.TimestampType()),
        T.StructField("last_updated", T.TimestampType()),
        T.StructField("block", T.StringType()),
    ]
)

ASIDE = T.StructType(
    [
        T.StructField("data", T.StringType()),
        T.StructField("publish_ts", T.TimestampType()),
        T.StructField("category", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("batch", T.StringType()),
    ]
)


def tap(df: DataFrame, name: str | Observation, time: str | None = None) -> DataFrame:
    """Pass rows through and report their number (and time span) as they flow.

    A stream reports under ``name`` in its progress events; a batch fills an Observation.
    """
    measures: list[Column] = [F.count(F.lit(1)).alias("rows")]
    if time is not None:
        first, last = format_time(F.min(time)), format_time(F.max(time))
        measures += [first.alias("first"), last.alias("last")]
    return df.observe(name, *measures)


class WindowTap:
    """A step for ``foreachBatch`` that notes what flows by: rows and time span, per batch and window.

    Each batch writes its counts into a folder of its own, which running it again replaces, so the
    report's sums are exact. Rows without a time are counted under a null window.
    """

    def __init__(self, spark: SparkSession, path: str, *, time: str = "publish_ts", size: str = "10 minutes"):
        self.spark, self.path, self.time, self.size = spark, path, time, size

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        start, end = window_bounds(F.col(self.time), self.size)
        rows = batch.select(F.col(self.time).alias("at"), start.alias("window_start"), end.alias("window_end"))
        counts = rows.groupBy("window_start", "window_end").agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"), F.max("at").alias("last"))
        counts.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def report(self) -> DataFrame:
        """``window_start, window_end, batch, rows, first, last`` of all batches so far."""
        schema = T.StructType([*(T.StructField(c, T.TimestampType()) for c in ("window_start", "window_end")), T.StructField("batch", T.LongType()),
                               T.StructField("rows", T.LongType()), T.StructField("first", T.TimestampType()), T.StructField("last", T.TimestampType())])
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path).select(*schema.names)

    def beside(self, step: Publisher) -> Publisher:
        """``step`` with this tap before it, over one evaluation of the batch."""

        def both(batch: DataFrame, batch_id: int) -> None:
            batch = batch.persist()
            try:
                self(batch, batch_id)
                step(batch, batch_id)
            finally:
                batch.unpersist()

        return both


def publish_files(path: str) -> Publisher:
    """Envelopes as JSON lines, one folder per batch; repeating a batch replaces its folder.

    A batch has as many files as its lines need, not one for each task that made some.
    """

    def publish(values: DataFrame, batch_id: int) -> None:
        lines = values.select("value").persist()
        try:
            files = max(1, -(-lines.count() // LINES_PER_FILE))
            lines.coalesce(files).write.mode("overwrite").text(f"{path}/batch={batch_id}")
        finally:
            lines.unpersist()

    return publish


def store_late(path: str) -> Publisher:
    """Late rows into a table of their own, one folder per batch that has some; repeating a batch replaces its folder."""

    def store(rows: DataFrame, batch_id: int) -> None:
        if not rows.isEmpty():
            rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return store


def publish_kafka(servers: str, topic: str, **options: str) -> Publisher:
    """Envelopes to a Kafka topic, ``attributes`` as headers. Needs Spark's Kafka package on the classpath."""

    def publish(values: DataFrame, batch_id: int) -> None:
        if "attributes" in values.columns:
            texts = F.transform(F.map_entries("attributes"), lambda e: F.struct(e["key"], F.encode(e["value"], "UTF-8").alias("value")))
            values = values.withColumn("headers", texts)
        kept = [c for c in ("value", "headers") if c in values.columns]
        writer = values.select(*kept).write.format("kafka").options(**options)
        writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()

    return publish


def as_deliveries(messages: DataFrame) -> DataFrame:
    """Messages as a subscriber gets them: base64 ``data`` and ``publish_ts``."""
    return messages.select(
        F.base64("value").alias("data"), F.col("timestamp").alias("publish_ts")
    )


class ResultStore:
    """The two stored tables: ``hot_topics``, one row per record time, and one-row ``stats``.

    A batch changes both by one commit, so no reader sees one of them ahead of the other. With
    ``strict`` a delivery that neither can take fails its batch. Otherwise it is set aside, by the
    same commit, in the table ``aside``: what came, when, and the reason.
    """

    def __init__(self, spark: SparkSession, path: str, *, strict: bool = True):
        self.strict = strict
        self.commits = Commits(spark, f"{path}/commits")
        self.hot_topics = ChangeLog(spark, path, STORED_TOPICS, ["timestamp"], "day", commits=self.commits, name="hot_topics")
        self.stats = ChangeLog(spark, path, STORED_STATS, ["id"], "block", commits=self.commits, name="stats")
        self.aside = ChangeLog(spark, path, ASIDE, [], "batch", commits=self.commits, name="aside")

    def apply(self, deliveries: DataFrame, batch_id: int) -> None:
        """Decode one batch of deliveries (``data``, ``publish_ts``) and upsert it by category.

        A batch that is stored already, or older than one that is, changes nothing. The last published wins, whichever batch delivers it, and the fuller one if published
        together. An unknown category fails the batch before anything of it is stored.
        """
        if self.commits.done(batch_id):
            return
        envelopes = decoded = (decode_delivery(deliveries) if self.strict else examine_deliveries(deliveries)).persist()
        try:
            entries = []
            if not self.strict:
                entries += self._set_aside(envelopes.filter("reason IS NOT NULL"), batch_id)
                envelopes = envelopes.filter("reason IS NULL").drop("data", "reason")
            topics = _topic_rows(routed_hot_topics(envelopes))
            stats = _stats_rows(routed_counts(envelopes))
            entries += self.hot_topics.stage(topics, batch_id, ["publish_ts", "mentions"])
            entries += self.stats.stage(stats, batch_id, ["publish_ts", "events"])
            self.commits.commit(batch_id, entries)
        finally:
            decoded.unpersist()

    def _set_aside(self, rows: DataFrame, batch_id: int) -> list[Entry]:
        """All of a batch's bad deliveries are a part of their own, which no other batch touches."""
        kept = rows.select("data", "publish_ts", "category", "reason", F.lit(str(batch_id)).alias("batch"))
        return self.aside.put(kept, batch_id)


def _topic_rows(records: DataFrame) -> DataFrame:
    mentions = F.aggregate("topics", F.lit(0).cast("bigint"), lambda sum_, t: sum_ + t["score"])
    latest = latest_by_key(records.withColumn("mentions", mentions), ["timestamp"], ["publish_ts", "mentions"])
    return latest.withColumns(
        {"last_updated": F.current_timestamp(), "day": F.substring("window.start", 1, 10)}
    )


def _stats_rows(counts: DataFrame) -> DataFrame:
    latest = latest_by_key(counts.withColumn("id", F.lit("stats")), ["id"], ["publish_ts", "events"])
    return latest.withColumns({"last_updated": F.current_timestamp(), "block": F.lit("all")})
