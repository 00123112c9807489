"""The registered streams over tables with missing times, gaps, one time only, or no rows."""

import datetime as dt

import pytest
from helpers import START, rows

from tidemark.registry.queries import QUERIES

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def _events(times):
    at = START.replace(tzinfo=None)
    return [(i, None if s is None else at + dt.timedelta(seconds=s), i * 7 % 13, "ab"[i % 2], 1.0, f'{{"k": {i % 30}}}') for i, s in enumerate(times)]


TABLES = {
    "gaps": _events([*range(0, 1200, 20), None, None, None, 20 * 86_400]),
    "one_time": _events([5] * 23),
    "few": _events([0, 90_000, None]),
    "no_time": _events([None] * 7),
    "empty": [],
}


@pytest.fixture(scope="module", params=TABLES)
def folder(request, spark, tmp_path_factory):
    path = tmp_path_factory.mktemp(request.param)
    spark.createDataFrame(TABLES[request.param], SCHEMA).coalesce(1).write.parquet(str(path / "events.parquet"))
    return request.param, str(path)


def _venues(name):
    return sorted(r[0] for r in TABLES[name] if r[2] % 4)


def test_streams_equal_batches(spark, folder):
    name, path = folder
    for stream, batch in [("stream_hot_topics", "hot_topics_10min"), ("stream_topic_panes", "topic_count_panes"), ("stream_counter_panes", "counter_panes")]:
        expected = QUERIES[batch](spark, path).drop("pane")
        assert rows(QUERIES[stream](spark, path).select(*expected.columns)) == rows(expected)
    assert rows(QUERIES["stream_counter"](spark, path)) == [(len(_venues(name)),)]


def test_every_message_reaches_the_sink(spark, folder):
    name, path = folder
    assert sorted(r.event_id for r in QUERIES["stream_table_sink"](spark, path).collect()) == _venues(name)
    assert sorted(r.event_id for r in QUERIES["stream_dedup"](spark, path).collect()) == _venues(name)


def test_stored_tables(spark, folder):
    name, path = folder
    stored = QUERIES["stream_store"](spark, path)
    windows = {r[1].date() for r in TABLES[name] if r[1] and r[2] % 4}
    assert stored.where("timestamp > 0").count() == len(windows)
    assert [r.events for r in stored.where("timestamp = 0").collect()] == ([len(_venues(name))] if _venues(name) else [])
