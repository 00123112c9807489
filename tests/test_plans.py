import json

import pytest
from helpers import ABSENT, START, as_text, message, messages, rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark.operators.panes import count_panes, fired_panes, last_panes
from tidemark.operators.ranking import latest_by_key
from tidemark.operators.shaping import (
    bind_category,
    decode_delivery,
    encode_envelope,
    format_hot_topics,
    route,
    routed_counts,
    routed_hot_topics,
)
from tidemark.operators import tables
from tidemark.operators.tables import schema_ddl, schema_string, select_schema, write_batch, write_table
from tidemark.plans import trending
from tidemark.schemas import GLOBAL_EVENTS, HOT_TOPICS, TOPICS_PER_COUNTRY
from tidemark.streaming.sinks import tap


@pytest.fixture(scope="module")
def frame(spark):
    """Twelve topics mentioned once in the first window, one three times; one in the next."""
    many = [(f"t{i:02}", f"T {i}") for i in range(12)]
    return messages(
        spark,
        [
            (message(many), 0),
            (message([("hot", "Hot $ topic"), ("hot", "Hot $ topic")], country="fr"), 599),
            (message([("hot", "Hot $ topic")], venue=None), 1),
            (message([("hidden", "Hidden")], venue=ABSENT), 2),
            (message([("next", "Next")]), 600),
            (message([]), 601),
        ],
    )


def test_counter_counts_what_passes_the_filter(frame):
    assert rows(trending.events_count(frame)) == [(5,)]


def test_nothing_in_nothing_out(frame):
    nothing = frame.filter("false")
    assert rows(trending.events_count(nothing)) == []
    assert rows(trending.hot_topics(nothing)) == []
    assert rows(trending.hot_topics_envelopes(trending.hot_topics(nothing))) == []


def test_top_ten_with_ties_at_the_cut(frame):
    top = trending.hot_topics(frame)
    picked = rows(top, as_text("window_start"), "rank", "topic_key", "score")
    first = [("2024-05-01 12:00:00", 1, "hot", 3)]
    first += [("2024-05-01 12:00:00", i + 2, f"t{i:02}", 1) for i in range(9)]
    assert picked == sorted([*first, ("2024-05-01 12:10:00", 1, "next", 1)], key=repr)


def test_invariants(frame):
    mentions = trending.topic_mentions(frame)
    scores = trending.topic_scores(mentions)
    assert scores.agg(F.sum("score")).first()[0] == mentions.count() == 16
    top = trending.hot_topics(frame, n=4)
    per_window = top.groupBy("window_start").agg(
        F.count("*").alias("rows"), F.countDistinct("topic_key", "topic_name").alias("topics")
    )
    assert all(r.rows == r.topics <= 4 for r in per_window.collect())


def test_strict_plan_agrees_on_clean_input(frame):
    assert rows(trending.hot_topics(frame, strict=True)) == rows(trending.hot_topics(frame))


def test_event_time_replaces_publish_time(frame):
    late = frame.withColumn("timestamp", F.expr("timestamp + INTERVAL 3 HOURS"))
    windows = trending.hot_topics(late, time="event").select(as_text("window_start")).distinct()
    assert rows(windows) == [("2024-05-01 12:00:00",)]


def test_by_country(frame):
    top = trending.hot_topics(frame, by_country=True).filter("topic_key = 'hot'")
    assert rows(top, "country", "rank", "score") == [("fr", 1, 2), ("us", 1, 1)]


def test_panes_are_the_running_counts(spark):
    frame = spark.range(23).select((F.col("id") % 2).alias("k"), "id")
    expected = [(0, 1, 5), (0, 2, 10), (1, 1, 5), (1, 2, 10)]
    assert rows(count_panes(frame, ["k"], 5)) == expected
    assert rows(last_panes(frame, ["k"], 5)) == [(0, 10), (1, 10)]
    fired = fired_panes(frame, ["k"], 5, [F.col("id")])
    assert rows(fired, "k", "pane", "running_count", "id") == [
        (0, 1, 5, 8), (0, 2, 10, 18), (1, 1, 5, 9), (1, 2, 10, 19),
    ]


def test_panes_do_not_depend_on_arrival(spark):
    frame = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    backwards = frame.orderBy(F.desc("id"))
    for form in (frame, backwards):
        assert rows(fired_panes(form, ["k"], 7, [F.col("id")])) == rows(
            fired_panes(frame, ["k"], 7, [F.col("id")])
        )


def test_a_key_with_very_many_panes_is_shared_out(spark):
    frame = spark.range(100_001).select(F.lit("hot").alias("k")).unionByName(
        spark.range(9).select(F.lit("cold").alias("k"))
    )
    panes = count_panes(frame, ["k"], 2)
    totals = panes.groupBy("k").agg(F.count("*"), F.countDistinct("pane"), F.max("running_count"))
    assert rows(totals) == [("cold", 4, 4, 8), ("hot", 50_000, 50_000, 100_000)]


def test_last_panes_are_the_latest_of_all_panes(spark):
    frame = spark.range(500).select((F.col("id") * F.col("id") % 11).alias("k"))
    latest = latest_by_key(count_panes(frame, ["k"], 5), ["k"], "pane").drop("pane")
    assert rows(latest) == rows(last_panes(frame, ["k"], 5))


def test_pane_faithful_ranking_leaves_out_rare_topics(spark):
    payloads = [message([("a", "A")])] * 7 + [message([("b", "B")])] * 4
    shown = trending.hot_topics_by_panes(messages(spark, payloads))
    assert rows(shown, "topic_key", "score") == [("a", 5)]


def test_hot_topics_record(frame):
    values = [json.loads(v) for (v,) in rows(trending.hot_topics_envelopes(trending.hot_topics(frame, n=1)))]
    start = int(START.timestamp())
    assert values[0] == {
        "category": "HOT_TOPICS",
        "output": {
            "topics": [{"topic_key": "hot", "topic_name": "Hot $ topic", "score": 3}],
            "timestamp": start + 600 + 999,
            "window": {"start": "2024-05-01 12:00:00", "end": "2024-05-01 12:10:00"},
        },
    }


def _delivered(values):
    return decode_delivery(values.select(F.base64(F.encode("value", "UTF-8")).alias("data")))


def test_delivery_round_trip(frame):
    top = trending.hot_topics(frame)
    published = trending.hot_topics_envelopes(top).unionByName(
        trending.count_envelopes(trending.events_count(frame))
    )
    back = _delivered(published)
    assert rows(routed_hot_topics(back)) == rows(format_hot_topics(top))
    assert rows(routed_counts(back)) == [(5,)]


@pytest.mark.parametrize("category", [TOPICS_PER_COUNTRY, "OTHER", None])
def test_unknown_category_is_an_error_on_every_route(spark, category):
    tagged = bind_category(spark.range(1), GLOBAL_EVENTS, F.col("id")).withColumn(
        "category", F.lit(category)
    )
    back = _delivered(encode_envelope(tagged))
    for wanted in (HOT_TOPICS, GLOBAL_EVENTS):
        with pytest.raises(Exception, match="unknown category"):
            route(back, wanted).collect()


def test_broken_delivery_is_an_error(spark):
    bad = spark.createDataFrame([("bm90IGpzb24=",)], "data string")
    with pytest.raises(Exception, match="(?i)malformed"):
        decode_delivery(bad).collect()


def test_tap_passes_rows_through(frame):
    seen = Observation()
    assert tap(frame, seen, "timestamp").count() == 6
    assert seen.get["rows"] == 6


def test_table_schema_forms():
    schema = {"id": "INTEGER", "name": "STRING", "at": "TIMESTAMP"}
    assert schema_string(schema) == "id:INTEGER, name:STRING, at:TIMESTAMP"
    assert schema_ddl(schema) == "`id` bigint, `name` string, `at` timestamp"
    with pytest.raises(ValueError, match="unknown column type"):
        schema_ddl({"id": "POINT"})


def test_table_sink_appends_only_the_schema(spark, tmp_path):
    frame = spark.range(3).select("id", F.lit("x").alias("name"), F.lit(1).alias("other"))
    schema = {"name": "STRING", "id": "FLOAT"}
    for _ in range(2):
        write_table(frame, "sink_test", schema, path=str(tmp_path / "sink"))
    stored = spark.table("sink_test")
    assert stored.dtypes == [("name", "string"), ("id", "double")]
    assert stored.count() == 6
    spark.sql("DROP TABLE sink_test")
    with pytest.raises(Exception, match="(?i)unresolved"):
        select_schema(frame, {"missing": "STRING"})


def test_each_payload_is_parsed_once(frame):
    """Filters inferred from topics and windows must not carry a copy of the parser."""
    for by_country in (False, True):
        plan = trending.hot_topics(frame, by_country=by_country)._jdf.queryExecution().executedPlan()
        assert plan.toString().count("from_json") == 1


def test_a_batch_is_appended_once(spark, tmp_path, monkeypatch):
    schema = {"id": "INTEGER", "name": "STRING"}
    path, frame = str(tmp_path / "once"), spark.createDataFrame([(1, "a", 9), (2, None, 9)], "id int, name string, x int")
    try:
        monkeypatch.setattr(tables, "move_new", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):  # killed before it has its place
            write_batch(frame, "once_test", schema, "it's 1/2", path=path)
        monkeypatch.undo()
        assert not spark.catalog.tableExists("once_test")
        assert write_batch(frame, "once_test", schema, "it's 1/2", path=path)
        assert not write_batch(frame.limit(0), "once_test", schema, "it's 1/2", path=path)
        assert write_batch(frame.filter("id = 2"), "once_test", schema, "b", path=path)
        expected = [(1, "a", "it's 1/2"), (2, None, "b"), (2, None, "it's 1/2")]
        assert sorted(map(tuple, spark.table("once_test").collect()), key=repr) == sorted(expected, key=repr)
        monkeypatch.setattr(tables, "path_exists", lambda spark, at, seen=[]: bool(seen) or seen.append(at))
        assert not write_batch(frame, "once_test", schema, "b", path=path)  # another writer was first to finish
        monkeypatch.undo()
        assert spark.table("once_test").count() == 3
        spark.sql("DROP TABLE once_test")
        assert not write_batch(frame, "once_test", schema, "b", path=path)  # the folders are the ledger
        assert spark.table("once_test").count() == 3
    finally:
        spark.sql("DROP TABLE IF EXISTS once_test")
    with pytest.raises(ValueError):
        write_batch(frame, "once_test", {"batch": "STRING"}, "b", path=path)
