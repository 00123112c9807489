"""The message log: whole segments, restarts by offset, and large partitions in pieces."""

import datetime as dt

import pytest
from helpers import START, message, messages, rows
from pyspark.sql import functions as F

from tidemark.plans import trending
from tidemark.sources import message_log
from tidemark.sources.message_log import Log, append_messages, read_message_log

NOW = {"availableNow": True}


def _frame(spark, first, n):
    frame = messages(spark, [(message([("a", "A")], event_id=i), i) for i in range(first, first + n)])
    return frame.withColumn("attributes", F.create_map(F.lit("n"), F.unix_seconds("timestamp").cast("string")))


def _run(spark, path, out):
    stream = read_message_log(spark, path, streaming=True)
    writer = stream.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state")
    query = writer.trigger(**NOW).start()
    query.awaitTermination()
    return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]


def _read(spark, out):
    return spark.read.schema(message_log.SCHEMA).parquet(f"{out}/rows")


def test_messages_as_they_were_appended(spark, tmp_path):
    path = str(tmp_path / "log")
    for first in (0, 40):
        append_messages(_frame(spark, first, 40), path, partitions=3, segment_rows=7)
    log = read_message_log(spark, path)
    assert rows(log.select("value", "timestamp", "attributes.n")) == rows(_frame(spark, 0, 80).select("value", "timestamp", "attributes.n"))
    for part in log.groupBy("partition").agg(F.sort_array(F.collect_list(F.struct("offset", "timestamp"))).alias("m")).collect():
        assert [m.offset for m in part.m] == list(range(len(part.m)))
    assert trending.events_count(log.select("value", "timestamp")).first()[0] == 80
    assert all(end - base <= 7 for listed in Log(path).segments().values() for base, end, _ in listed)


def test_a_restart_neither_loses_nor_repeats(spark, tmp_path):
    path, out = str(tmp_path / "log"), str(tmp_path / "out")
    append_messages(_frame(spark, 0, 30), path, partitions=2, segment_rows=10)
    assert _run(spark, path, out) == [30]
    append_messages(_frame(spark, 30, 5), path, partitions=2, segment_rows=10)
    append_messages(_frame(spark, 35, 20), path, partitions=4, segment_rows=10)  # more partitions than before
    assert sum(_run(spark, path, out)) == 25
    assert _run(spark, path, out) == []
    assert rows(_read(spark, out), "value") == rows(_frame(spark, 0, 55), "value")


def test_a_batch_that_failed_is_read_again(spark, tmp_path):
    path, out = str(tmp_path / "log"), str(tmp_path / "out")
    append_messages(_frame(spark, 0, 20), path, partitions=2)
    seen = []

    def run():
        def step(batch, batch_id):
            seen.append((batch_id, rows(batch, "partition", "offset")))
            if len(seen) == 1:
                raise ValueError("lost")

        stream = read_message_log(spark, path, streaming=True)
        stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{out}/state").trigger(**NOW).start().awaitTermination()

    with pytest.raises(Exception, match="lost"):
        run()
    append_messages(_frame(spark, 20, 10), path, partitions=2)
    run()  # the failed batch alone, as the trigger makes one batch
    run()
    assert [b for b, _ in seen] == [0, 0, 1] and seen[0] == seen[1] and len(seen[0][1]) == 20 and len(seen[2][1]) == 10


def test_a_partition_is_read_in_pieces(spark, tmp_path):
    path = str(tmp_path / "log")
    append_messages(_frame(spark, 0, 50), path, partitions=1, segment_rows=8)
    pieces = Log(path).between({0: 10}, {0: 45})
    assert [(p.base, p.start, p.end) for p in pieces] == [(8, 10, 16), (16, 16, 24), (24, 24, 32), (32, 32, 40), (40, 40, 45)]
    assert read_message_log(spark, path).rdd.getNumPartitions() == 7


def test_segments_behind_a_gap_are_not_seen(spark, tmp_path):
    path = str(tmp_path / "log")
    append_messages(_frame(spark, 0, 30), path, partitions=1, segment_rows=10)
    (listed,) = Log(path).segments().values()
    middle = listed[1][2].rsplit("/", 1)[0]
    hidden = (tmp_path / "hidden").as_posix()
    (tmp_path / "hidden").parent.joinpath(middle).rename(hidden)
    assert Log(path).ends() == {0: 10} and read_message_log(spark, path).count() == 10
    (tmp_path / "hidden").rename(middle)
    assert Log(path).ends() == {0: 30}


def test_nothing_in_the_log(spark, tmp_path):
    path = str(tmp_path / "log")
    assert read_message_log(spark, path).count() == 0
    assert _run(spark, path, str(tmp_path / "out")) == []
    append_messages(_frame(spark, 0, 5).limit(0), path)
    assert read_message_log(spark, path).count() == 0
    odd = spark.createDataFrame([(None, None), (bytearray(b""), START + dt.timedelta(seconds=1))], "value binary, timestamp timestamp")
    append_messages(odd, path, partitions=2)
    assert rows(read_message_log(spark, path).select("value", "timestamp", "attributes")) == rows(odd.withColumn("attributes", F.lit(None)))
