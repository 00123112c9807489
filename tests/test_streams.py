import time

import pytest
from helpers import ABSENT, START, as_text, message, messages, rows
from pyspark.sql import functions as F

from tidemark.functions.times import format_time
from tidemark.operators.intake import decode_messages, drop_duplicate_messages, parse_messages
from tidemark.operators.panes import count_panes
from tidemark.operators.shaping import decode_delivery, routed_counts, routed_hot_topics
from tidemark.operators.tables import stream_to_table
from tidemark.plans import trending
from tidemark.registry import queries
from tidemark.sources.messages import read_json_lines, read_message_files, read_table, stream_table
from tidemark.streaming import jobs, sinks
from tidemark.streaming.panes import stream_count_panes
from tidemark.streaming.store import ChangeLog, Commits
from tidemark.workspace import move_new

NOW = {"availableNow": True}
BATCHES = 4


def _payload(i):
    topics = [("all", "All"), (f"k{i % 5}", f"K {i % 5}"), (f"m{i * i % 23}", "M")]
    return message(topics, event_id=i, venue=ABSENT if i % 7 == 0 else {"venue_id": i})


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Messages over half an hour, in files that arrive in order."""
    path = str(tmp_path_factory.mktemp("stream") / "messages")
    for batch in range(BATCHES):
        chunk = range(batch * 60, batch * 60 + 60)
        frame = messages(spark, [(_payload(i), i * 8) for i in chunk])
        frame.coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    return path


@pytest.fixture
def stream(spark, folder):
    return read_message_files(spark, folder, streaming=True, max_files_per_trigger=1)


@pytest.fixture
def batch(spark, folder):
    return read_message_files(spark, folder)


def test_counter_grows_to_the_batch_count(spark, stream, batch, tmp_path):
    out = str(tmp_path / "out")
    jobs.start_counter(
        stream, sinks.publish_files(out), checkpoint=str(tmp_path / "c"), trigger=NOW
    ).awaitTermination()
    counts = spark.read.text(out).select(F.get_json_object("value", "$.output").cast("int"))
    seen = [r[0] for r in rows(counts)]
    assert len(seen) == BATCHES
    assert max(seen) == trending.events_count(batch).first()[0]


def test_early_rankings_end_as_the_batch_ranking(spark, stream, batch, tmp_path):
    place = {"rankings": str(tmp_path / "r"), "checkpoint": str(tmp_path / "c")}
    jobs.start_hot_topics(
        stream, sinks.publish_files(str(tmp_path / "out")), n=3, watermark="1 hour", trigger=NOW, **place
    ).awaitTermination()
    expected = trending.hot_topics(batch, n=3)
    log = jobs.rankings_log(spark, place["rankings"])
    assert rows(log.current().select(*expected.columns)) == rows(expected)
    assert all(len(log.versions(day)) == 2 for day in log.touched(log.current()))
    published = spark.read.text(str(tmp_path / "out")).count()
    assert published > expected.select("window_start").distinct().count()


def test_rankings_of_panes_end_as_in_batch(spark, stream, batch, tmp_path):
    place = {"rankings": str(tmp_path / "r"), "checkpoint": str(tmp_path / "c")}
    publish = sinks.publish_files(str(tmp_path / "out"))
    jobs.start_hot_topics(stream, publish, n=3, every=5, watermark=None, trigger=NOW, **place).awaitTermination()
    expected = trending.hot_topics_by_panes(batch, n=3)
    current = jobs.rankings_log(spark, place["rankings"]).current()
    assert rows(current.select(*expected.columns)) == rows(expected)


def test_counter_published_at_each_firing(spark, stream, batch, tmp_path):
    out = str(tmp_path / "out")
    jobs.start_counter(
        stream, sinks.publish_files(out), every=50, checkpoint=str(tmp_path / "c"), trigger=NOW
    ).awaitTermination()
    counts = spark.read.text(out).select(F.get_json_object("value", "$.output").cast("int"))
    total = trending.events_count(batch).first()[0]
    assert rows(counts) == sorted([(c,) for c in range(50, total + 1, 50)], key=repr)


def test_final_rankings_come_once_per_closed_window(spark, stream, batch, tmp_path):
    out = str(tmp_path / "out")
    jobs.start_final_hot_topics(
        stream,
        sinks.publish_files(out),
        checkpoint=str(tmp_path / "c"),
        watermark="1 minute",
        trigger=NOW,
    ).awaitTermination()
    top = trending.hot_topics(batch)
    last = batch.agg(F.max("timestamp") - F.expr("INTERVAL 1 MINUTE")).first()[0]
    closed = trending.hot_topics_envelopes(top.filter(F.col("window_end") <= F.lit(last)))
    assert closed.count() > 1
    assert rows(spark.read.text(out).select("value")) == rows(closed)


def test_topic_panes_equal_batch(spark, stream, batch, tmp_path):
    keys = ["window_start", "topic_key"]
    panes = stream_count_panes(trending.with_window(trending.topic_mentions(stream)), keys, 5)
    writer = panes.writeStream.format("parquet").option("path", str(tmp_path / "out"))
    writer.option("checkpointLocation", str(tmp_path / "c")).trigger(**NOW).start().awaitTermination()
    got = spark.read.schema(panes.schema).parquet(str(tmp_path / "out"))
    assert rows(got.select("fired_by").distinct()) == [("count",)]
    expected = count_panes(trending.with_window(trending.topic_mentions(batch)), keys, 5)
    assert rows(got.drop("fired_by")) == rows(expected.drop("pane"))


def test_waiting_rows_are_shown_by_the_timer(spark, tmp_path):
    path = str(tmp_path / "m")
    messages(spark, [message([], event_id=i) for i in range(5)]).coalesce(1).write.parquet(path)
    source = decode_messages(read_message_files(spark, path, streaming=True))
    panes = stream_count_panes(source, [], 2, after_seconds=1)
    timed = _run_until(spark, panes, "timed_panes", 3, tmp_path)
    assert rows(timed) == [(2, "count"), (4, "count"), (5, "time")]


def test_panes_with_state_that_expires(spark, stream, batch, tmp_path):
    """A long enough memory changes nothing."""
    panes = stream_count_panes(trending.topic_mentions(stream), ["topic_key"], 5, forget_after_seconds=3600)
    expected = rows(count_panes(trending.topic_mentions(batch), ["topic_key"], 5).drop("pane"))
    got = _run_until(spark, panes, "expiring_panes", len(expected), tmp_path)
    assert rows(got.drop("fired_by")) == expected


def _run_until(spark, df, name, count, tmp_path):
    """Timers and expiry keep a query running with no input, so wait for the rows instead."""
    query = (
        df.writeStream.format("memory")
        .queryName(name)
        .option("checkpointLocation", str(tmp_path / "c"))
        .trigger(processingTime="1 second")
        .start()
    )
    try:
        for _ in range(120):
            if query.exception() or spark.table(name).count() >= count:
                break
            time.sleep(0.5)
        time.sleep(3)  # nothing more may come
    finally:
        query.stop()
    return spark.table(name)


def test_stream_drops_duplicates_by_id(spark, tmp_path):
    path = str(tmp_path / "m")
    for _ in range(2):
        payloads = [message([], event_id=i % 3) for i in range(6)]
        messages(spark, payloads).coalesce(1).write.mode("append").parquet(path)
    source = read_message_files(spark, path, streaming=True, max_files_per_trigger=1)
    once = drop_duplicate_messages(parse_messages(trending.venue_messages(source))).select("event_id")
    schema = {"event_id": "INTEGER"}
    stream_to_table(
        once, "dedup_test", schema, checkpoint=str(tmp_path / "c"), path=str(tmp_path / "t")
    ).stop()  # the table exists and its query can be stopped and resumed
    writer = once.writeStream.format("parquet").option("path", str(tmp_path / "out"))
    writer.option("checkpointLocation", str(tmp_path / "c2")).trigger(**NOW).start().awaitTermination()
    got = spark.read.schema(once.schema).parquet(str(tmp_path / "out"))
    assert rows(got) == [("0",), ("1",), ("2",)]
    spark.sql("DROP TABLE dedup_test")


def test_json_lines_source(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.createDataFrame([(message([("a", "A")]),)], "value string").write.text(path)
    frame = read_json_lines(spark, path)
    assert frame.columns == ["value", "timestamp"]
    assert rows(trending.topic_mentions(frame), "topic_key") == [("a",)]


def _delivery(spark, values, after=0):
    data = [(v, START.replace(minute=after)) for v in values]
    frame = spark.createDataFrame(data, "value string, publish_ts timestamp")
    return frame.select(F.base64(F.encode("value", "UTF-8")).alias("data"), "publish_ts")


def _ranking(timestamp, *scores):
    topics = ",".join(f'{{"topic_key":"t","topic_name":"T","score":{s}}}' for s in scores)
    window = '{"start":"2024-05-01 12:00:00","end":"2024-05-01 12:10:00"}'
    output = f'{{"topics":[{topics}],"timestamp":{timestamp},"window":{window}}}'
    return f'{{"category":"HOT_TOPICS","output":{output}}}'


def _count(n):
    return f'{{"category":"GLOBAL_EVENTS","output":{n}}}'


def test_store_upserts_by_key_and_replay_changes_nothing(spark, tmp_path):
    store = sinks.ResultStore(spark, str(tmp_path))
    first = _delivery(spark, [_ranking(7, 1), _ranking(8, 1), _count(2)])
    second = _delivery(spark, [_ranking(7, 5, 4), _count(4), _count(6)], after=1)

    def state():
        topics = store.hot_topics.current().select("timestamp", "topics.score")
        return rows(topics), rows(store.stats.current(), "events")

    store.apply(first, 0)
    assert state() == ([(7, [1]), (8, [1])], [(2,)])
    store.apply(second, 1)
    expected = ([(7, [5, 4]), (8, [1])], [(6,)])
    assert state() == expected
    store.apply(second, 1)
    assert state() == expected
    store.apply(first, 0)  # an older batch run again must not win
    assert state() == expected
    late = _delivery(spark, [_ranking(7, 100), _count(100)], after=0)
    store.apply(late, 2)  # published before what is stored
    assert state() == expected
    store.apply(_delivery(spark, [_count(1)], after=2), 3)  # published after it
    assert state()[1] == [(1,)]


def test_files_read_by_a_batch_stay_few(spark, tmp_path):
    store = sinks.ResultStore(spark, str(tmp_path))
    files = []
    for batch in range(50):
        store.stats.merge(_stats_row(spark, batch), batch, ["publish_ts", "events"])
        if batch % 7 == 0:
            files.append((len(store.stats.versions("all")), len(store.stats.newest(["all"], before=batch).inputFiles())))
    assert rows(store.stats.current(), "events") == [(49,)]
    assert all(versions <= 2 and read <= 1 for versions, read in files)


def _stats_row(spark, n):
    row = ("stats", n, START.replace(minute=n), START, "all")
    return spark.createDataFrame([row], "id string, events long, publish_ts timestamp, last_updated timestamp, block string")


def _state(store):
    return rows(store.hot_topics.current().select("timestamp", "topics.score")), rows(store.stats.current(), "events")


def test_a_batch_is_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    """A reader between the writes and the commit, and after a batch was killed there, sees the version before."""
    store = sinks.ResultStore(spark, str(tmp_path))
    store.apply(_delivery(spark, [_ranking(7, 1), _count(2)]), 0)
    before = _state(store)
    opened = store.hot_topics.current()
    second = _delivery(spark, [_ranking(7, 5), _ranking(8, 2), _count(9)], after=1)
    commit = Commits.commit

    def killed(self, version, changed):
        assert {table for table, _, _ in changed} == {"hot_topics", "stats"}
        assert _state(sinks.ResultStore(spark, str(tmp_path))) == before
        raise RuntimeError("killed")

    monkeypatch.setattr(Commits, "commit", killed)
    with pytest.raises(RuntimeError, match="killed"):
        store.apply(second, 1)
    assert _state(store) == before
    monkeypatch.setattr(Commits, "commit", commit)
    store.apply(second, 1)
    assert _state(store) == ([(7, [5]), (8, [2])], [(9,)])
    assert rows(opened.select("timestamp", "topics.score")) == before[0]
    assert store.commits.versions() == [0, 1]
    store.apply(_delivery(spark, [_count(10)], after=2), 2)
    assert store.commits.versions() == [1, 2] and store.hot_topics.versions("2024-05-01") == [1, 1]
    assert _state(store) == ([(7, [5]), (8, [2])], [(10,)])


def test_a_second_writer_of_a_version_is_refused(spark, tmp_path):
    schema = "id long, part string"
    log = ChangeLog(spark, str(tmp_path), spark.createDataFrame([], schema).schema, ["id"], "part")
    log.merge(spark.createDataFrame([(1, "a/b=c"), (2, None), (3, "")], schema), 0, [])
    assert rows(log.current(), "id", "part") == rows(log.newest(["a/b=c", "none"]), "id", "part") == [(1, "a/b=c"), (2, "none"), (3, "none")]
    draft = str(tmp_path / "draft")
    spark.range(1).write.parquet(draft)
    with pytest.raises(Exception, match="FileAlreadyExists|already exists"):
        move_new(spark, draft, f"{log.commits.path}/{0:020d}")
    assert log.current().count() == 3


def test_a_part_replaced_by_nothing_is_empty(spark, tmp_path):
    schema = "id long, part string"
    log = ChangeLog(spark, str(tmp_path), spark.createDataFrame([], schema).schema, ["id"], "part")
    log.merge(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], schema), 0, [])
    log.replace(spark.createDataFrame([(4, "b")], schema), 1, ["a", "b"])
    assert rows(log.current(), "id") == rows(log.newest(["a", "b", "c"]), "id") == [(3,), (4,)]
    log.merge(spark.createDataFrame([(5, "a")], schema), 2, [])
    assert rows(log.current(), "id") == [(3,), (4,), (5,)]


def test_current_reads_only_committed_files(spark, tmp_path):
    """Without a list of parts in the driver: the commit prunes the partitions of the files."""
    schema = "id long, part string"
    log = ChangeLog(spark, str(tmp_path), spark.createDataFrame([], schema).schema, ["id"], "part")
    for version in range(3):
        log.merge(spark.createDataFrame([(version, f"p{version}")], schema), version, [])
    plan = log.current()._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan
    assert rows(log.current(), "id") == [(0,), (1,), (2,)]


def test_unknown_category_stores_nothing(spark, tmp_path):
    store = sinks.ResultStore(spark, str(tmp_path))
    bad = _delivery(spark, [_ranking(7, 1), '{"category":"TOPICS_PER_COUNTRY","output":1}'])
    with pytest.raises(Exception, match="unknown category"):
        store.apply(bad, 0)
    assert store.hot_topics.current().count() == store.stats.current().count() == 0


def test_bad_deliveries_are_set_aside_with_their_reason(spark, tmp_path):
    store = sinks.ResultStore(spark, str(tmp_path), strict=False)
    good = _delivery(spark, [_ranking(7, 1), _count(2)])
    texts = {
        '{"category":"TOPICS_PER_COUNTRY","output":1}': "unknown category", '{"output":1}': "unknown category", "[1, 2]": "not a JSON object",
        '{"category":"GLOBAL_EVENTS"': "not a JSON object", '{"category":"GLOBAL_EVENTS","output":"x"}': "unreadable output",
        '{"category":"GLOBAL_EVENTS","output":1.5}': "unreadable output", '{"category":"GLOBAL_EVENTS"}': "unreadable output",
        '{"category":"HOT_TOPICS","output":{"topics":[]}}': "unreadable output", '{"category":"HOT_TOPICS","output":3}': "unreadable output",
    }
    bad = _delivery(spark, list(texts))
    raw = spark.createDataFrame([("%%%", START), (None, None), ("/w==", START)], bad.schema)
    store.apply(good.unionByName(bad).unionByName(raw), 0)
    assert rows(store.stats.current(), "events") == [(2,)] and rows(store.hot_topics.current(), "timestamp") == [(7,)]
    aside = store.aside.current()
    got = {(r.text, r.reason) for r in aside.select(F.unbase64(F.when(F.length("data") > 4, F.col("data"))).cast("string").alias("text"), "reason").collect()}
    assert got == {*texts.items(), (None, "not base64"), (None, "not UTF-8")} and aside.count() == len(texts) + 3
    store.apply(raw, 1)
    store.apply(good, 2)
    assert rows(store.aside.current().groupBy("batch").count()) == [("0", len(texts) + 3), ("1", 3)]


def test_publish_store_pipeline(spark, stream, batch, tmp_path):
    jobs.start_counter(
        stream,
        sinks.publish_files(str(tmp_path / "out/counter")),
        checkpoint=str(tmp_path / "c1"),
        trigger=NOW,
    ).awaitTermination()
    store = sinks.ResultStore(spark, str(tmp_path / "store"))
    published = read_json_lines(spark, str(tmp_path / "out"), streaming=True)
    deliveries = sinks.as_deliveries(published)
    jobs.start_store(deliveries, store, checkpoint=str(tmp_path / "c2"), trigger=NOW).awaitTermination()
    assert rows(store.stats.current(), "events") == rows(trending.events_count(batch))


def test_change_log_reads_only_named_parts(spark, tmp_path):
    schema = spark.range(1).select("id", F.lit("a").alias("part")).schema
    log = ChangeLog(spark, str(tmp_path / "log"), schema, ["id"], "part")
    assert log.current().count() == 0
    frame = spark.range(6).select("id", F.concat(F.lit("p"), F.col("id") % 3).alias("part"))
    log.merge(frame, 3, [])
    assert rows(log.newest(["p1", "nowhere"]), "id", "version") == [(1, 3), (4, 3)]
    assert log.newest(["p1"], before=3).count() == 0
    log.merge(frame.filter("id = 1"), 4, [])
    assert rows(log.at(["p1", "p2"], 4), "id") == [(1,), (4,)]
    log.merge(frame.filter("id = 1"), 5, [])
    assert log.versions("p1") == [4, 5] and log.versions("p2") == [3]
    assert rows(log.current(), "id") == [(i,) for i in range(6)]


def test_state_of_panes_is_forgotten(spark, stream, tmp_path):
    """With a memory of a second, rows in state go some time after a key's last row."""
    panes = stream_count_panes(trending.topic_mentions(stream), ["topic_key"], 5, forget_after_seconds=1)
    query = (
        panes.writeStream.format("memory").queryName("forgotten").option("checkpointLocation", str(tmp_path / "c"))
        .trigger(processingTime="1 second").start()
    )
    try:
        held = [0]
        for _ in range(60):
            held = [_values_in_state(p) for p in query.recentProgress if p["stateOperators"]] or [0]
            if held[-1] < max(held) or query.exception():
                break
            time.sleep(1)
        assert query.exception() is None and held[-1] < max(held)
    finally:
        query.stop()


def _values_in_state(progress):
    return sum(op["numRowsTotal"] for op in progress["stateOperators"])


def test_rows_dropped_as_late_are_reported(spark, tmp_path):
    path = str(tmp_path / "m")
    for after in (0, 7200, 7300, 60, 9000):  # a watermark counts from the batch after next
        messages(spark, [(message([("a", "A")]), after)]).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    source = read_message_files(spark, path, streaming=True, max_files_per_trigger=1)
    query = jobs.start_hot_topics(
        source, sinks.publish_files(str(tmp_path / "o")), rankings=str(tmp_path / "r"), checkpoint=str(tmp_path / "c"),
        watermark="10 minutes", trigger=NOW,
    )
    query.awaitTermination()
    assert jobs.late_rows(query) == 1


def test_late_rows_are_kept_apart(spark, tmp_path):
    """Rows kept and rows late make up rows read, one without a time among them."""
    path = str(tmp_path / "m")
    for batch in ([0, 5], [7200], [7300, 60, None], [100, 7250, 9000], [20000]):
        payloads = [(message([("a", "A")]), s) for s in batch if s is not None]
        frame = messages(spark, payloads)
        if None in batch:
            frame = frame.unionByName(frame.limit(1).withColumn("timestamp", F.lit(None).cast("timestamp")))
        frame.coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    source = read_message_files(spark, path, streaming=True, max_files_per_trigger=1)
    query = jobs.start_final_hot_topics(
        source, sinks.publish_files(str(tmp_path / "o")), checkpoint=str(tmp_path / "c"), watermark="10 minutes",
        late=sinks.store_late(str(tmp_path / "late")), trigger=NOW,
    )
    query.awaitTermination()
    late = spark.read.parquet(str(tmp_path / "late"))
    assert rows(late.select(as_text("window_start"), "topic_key", "rows", "batch")) == sorted(
        [("2024-05-01 12:00:00", "a", 1, 2), (None, "a", 1, 2), ("2024-05-01 12:00:00", "a", 1, 3)], key=repr
    )
    records = spark.read.text(str(tmp_path / "o")).select(F.from_json("value", "output struct<topics array<struct<score bigint>>>").alias("r"))
    scores = rows(records.select(F.explode("r.output.topics.score")))
    assert scores == [(1,), (2,), (3,)]
    assert sum(s for s, in scores) + late.count() + 1 == spark.read.parquet(path).count()  # the newest window is still open


def test_a_tap_notes_batches_and_windows(spark, tmp_path):
    tap, out = sinks.WindowTap(spark, str(tmp_path / "tap")), []
    assert tap.report().count() == 0
    frame = decode_messages(messages(spark, [(message([]), s) for s in (0, 599, 600)])).unionByName(
        decode_messages(messages(spark, [message([])])).withColumn("publish_ts", F.lit(None).cast("timestamp"))
    )
    step = tap.beside(lambda batch, batch_id: out.append((batch_id, batch.count())))
    for batch_id in (0, 1, 1):
        step(frame, batch_id)
    noted = tap.report().select("batch", as_text("window_start"), as_text("window_end"), "rows", as_text("first"), as_text("last"))
    one = [
        ("2024-05-01 12:00:00", "2024-05-01 12:10:00", 2, "2024-05-01 12:00:00", "2024-05-01 12:09:59"),
        ("2024-05-01 12:10:00", "2024-05-01 12:20:00", 1, "2024-05-01 12:10:00", "2024-05-01 12:10:00"), (None, None, 1, None, None),
    ]
    assert rows(noted) == sorted([(b, *r) for b in (0, 1) for r in one], key=repr) and out == [(0, 4), (1, 4), (1, 4)]


def test_texts_and_folders_are_in_utc_whatever_the_session(spark, stream, batch, tmp_path):
    expected = rows(trending.hot_topics_envelopes(trending.hot_topics(batch, n=3)))
    zone = "spark.sql.session.timeZone"
    spark.conf.set(zone, "America/New_York")
    try:
        assert rows(trending.hot_topics_envelopes(trending.hot_topics(batch, n=3))) == expected
        jobs.start_hot_topics(
            stream, sinks.publish_files(str(tmp_path / "o")), rankings=str(tmp_path / "r"), checkpoint=str(tmp_path / "c"),
            n=3, watermark=None, trigger=NOW,
        ).awaitTermination()
        assert jobs.rankings_log(spark, str(tmp_path / "r")).versions("2024-05-01")
        odd = spark.sql("SELECT timestamp_seconds(1710052200) AS a, timestamp_seconds(1730611800) AS b")
        assert rows(odd.select(format_time(F.col("a")), format_time(F.col("b")))) == [("2024-03-10 06:30:00", "2024-11-03 05:30:00")]
    finally:
        spark.conf.set(zone, "UTC")


def test_a_delivery_is_parsed_once(spark):
    frame = decode_delivery(_delivery(spark, [_ranking(7, 1), _count(2)]))
    for routed, parsers in ((routed_hot_topics(frame), 2), (routed_counts(frame), 1)):
        plan = routed.filter("publish_ts IS NOT NULL")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == parsers


def test_both_branches_of_one_source(spark, stream, batch, tmp_path):
    publish = {name: sinks.publish_files(str(tmp_path / name)) for name in ("counter", "hot_topics")}
    running = jobs.start_all(stream, publish, folder=str(tmp_path / "state"), watermark="1 hour", trigger=NOW, n=3)
    for query in running.values():
        query.awaitTermination()
    counts = spark.read.text(str(tmp_path / "counter")).select(F.get_json_object("value", "$.output").cast("int"))
    assert max(rows(counts))[0] == trending.events_count(batch).first()[0]
    current = jobs.rankings_log(spark, str(tmp_path / "state/rankings")).current()
    expected = trending.hot_topics(batch, n=3)
    assert rows(current.select(*expected.columns)) == rows(expected)


def test_windows_are_text_in_utc(batch):
    top = trending.hot_topics(batch).select(as_text("window_start")).distinct()
    assert ("2024-05-01 12:00:00",) in rows(top)


def test_table_streams_from_a_file_or_a_folder(spark, tmp_path):
    """On a cluster a table is a folder of files; here it is one file."""
    given = "/root/testdata/sf0.001"
    events = read_table(spark, given, "events")
    events.repartition(5).write.parquet(str(tmp_path / "events.parquet"))
    expected = rows(events.select("event_id"))
    for folder in (given, str(tmp_path)):
        streamed = stream_table(spark, folder, "events", "event_id", max_files_per_trigger=2)
        out = str(tmp_path / f"out{len(folder)}")
        writer = streamed.writeStream.format("parquet").option("path", out)
        writer.option("checkpointLocation", f"{out}-c").trigger(**NOW).start().awaitTermination()
        assert rows(spark.read.schema("event_id bigint").parquet(out)) == expected


class _Stream:
    """A running stream that makes one batch of ten rows, nine of them kept, per look."""

    def __init__(self, batches, error=None):
        self.batches, self.error, self.looks = batches, error, 0
        self.isActive, self.status = True, {"isTriggerActive": False}

    @property
    def recentProgress(self):
        self.looks += 1
        made = range(max(0, self.looks - 3), min(self.looks, self.batches))
        return [{"batchId": i, "timestamp": str(i), "numInputRows": 10, "observedMetrics": {"venue_messages": {"rows": 9}}} for i in made]

    def exception(self):
        return self.error if self.looks > 3 else None


def test_timed_counter_waits_for_the_whole_total(monkeypatch):
    monkeypatch.setattr(queries.time, "sleep", lambda s: None)
    slow = _Stream(batches=500)
    assert queries._timed_total(slow, 5000, lambda: 9 * min(slow.looks - 5, 500)) == 4500
    assert slow.looks == 505


def test_timed_counter_raises_instead_of_a_part(monkeypatch):
    monkeypatch.setattr(queries.time, "sleep", lambda s: None)
    with pytest.raises(ValueError, match="broken"):
        queries._timed_total(_Stream(2, ValueError("broken")), 50, lambda: 18)
    with pytest.raises(RuntimeError, match="stalled after 20 of 50 rows"):
        queries._timed_total(_Stream(2), 50, lambda: 18, stall=0.05)
    ended = _Stream(5)
    ended.isActive = False
    with pytest.raises(RuntimeError, match="ended"):
        queries._timed_total(ended, 50, lambda: 18)
