import json

import pytest
from helpers import ABSENT, message, messages, rows, texts
from pyspark.sql import functions as F

from tidemark.functions.payload import at_path, encode_json, variant_state
from tidemark.functions.times import event_time, format_time, pane_timestamp
from tidemark.operators.intake import quarantine_groups  # noqa: E402
from tidemark.operators.intake import (
    decode_messages,
    drop_duplicate_messages,
    keep_with_key,
    null_without_key,
    parse_messages,
    quarantine,
)
from tidemark.operators.topics import explode_topics
from tidemark.plans import trending
from tidemark.schemas import GROUP_ONLY, OPEN_MESSAGE
from tidemark.sources.messages import spread
from tidemark.sources.records import project_records, with_attributes

KEPT = ['{"venue":null}', '{"venue":{}}', '{"a":1,"venue":{"id":2}}', '{"\\u0076enue":1}']
DROPPED = ['{"a":{"venue":1}}', "{}", "[1]", '["venue"]', '"venue"', "7", "null"]
BROKEN = ['{"venue":1', '{"venue":[1,}', "venue", ""]


def test_venue_key_present_whatever_its_value(spark):
    kept = keep_with_key(texts(spark, *KEPT, *DROPPED, *BROKEN, None), "venue")
    assert rows(kept) == sorted([(t,) for t in KEPT], key=repr)


def test_text_without_key_is_nulled(spark):
    kept = null_without_key(texts(spark, *KEPT, *DROPPED, *BROKEN, None), "venue")
    assert kept.count() == len(KEPT + DROPPED + BROKEN) + 1
    assert rows(kept.filter("text IS NOT NULL")) == sorted([(t,) for t in KEPT], key=repr)


def test_strict_keeps_the_same_and_raises_on_broken(spark):
    good = keep_with_key(texts(spark, *KEPT, *DROPPED), "venue", strict=True)
    assert good.count() == len(KEPT)
    for broken in BROKEN:
        with pytest.raises(Exception, match="malformed message"):
            keep_with_key(texts(spark, broken), "venue", strict=True).collect()


def test_quarantine_holds_what_no_plan_can_use(spark):
    held = quarantine(texts(spark, *KEPT, "{}", "[1]", *BROKEN, None))
    assert rows(held) == sorted([(t,) for t in ["[1]", *BROKEN, None]], key=repr)


def test_bad_bytes(spark):
    frame = messages(spark, ["{}", b'{"venue":"\xff"}', "é".encode()])
    assert rows(decode_messages(frame), "text") == [("{}",), ("é",), (None,)]
    with pytest.raises(Exception, match="(?i)malformed"):
        decode_messages(frame, strict=True).collect()


def test_last_of_repeated_json_keys_wins(spark):
    text = '{"group":{"group_country":"a"},"group":{"group_country":"b"}}'
    assert rows(parse_messages(texts(spark, text), GROUP_ONLY), "group.group_country") == [("b",)]


def test_broken_text_parses_to_nothing_or_raises(spark):
    assert rows(parse_messages(texts(spark, "{"), GROUP_ONLY)) == [(None,)]
    with pytest.raises(Exception, match="(?i)malformed"):
        parse_messages(texts(spark, "{"), GROUP_ONLY, strict=True).collect()


def test_numbers_and_digit_strings_are_both_times(spark):
    frame = texts(spark, '{"timestamp":1500}', '{"timestamp":"1500"}')
    times = parse_messages(frame).select(event_time(F.col("timestamp")).cast("double"))
    assert rows(times) == [(1.5,), (1.5,)]


def test_time_formats(spark):
    row = spark.range(1).select(
        format_time(F.timestamp_millis(F.lit(1714564801999))).alias("text"),
        pane_timestamp(F.timestamp_seconds(F.lit(600))).alias("pane"),
    )
    assert rows(row) == [("2024-05-01 12:00:01", 1599)]


def test_topics_explode(spark):
    parsed = parse_messages(
        texts(
            spark,
            message([("a", "A"), ("a", "A"), ("b$c", "B$ C")]),
            message([]),
            '{"venue":1}',
            '{"group":{"group_country":"us"}}',
            '{"group":{"group_country":"us","group_topics":null}}',
        ),
        GROUP_ONLY,
    )
    assert rows(explode_topics(parsed)) == [("a", "A"), ("a", "A"), ("b$c", "B$ C")]


@pytest.mark.parametrize("group", ['{"group_topics":[]}', '{"group_country":"us"}', "null"])
def test_strict_group_must_be_complete(spark, group):
    parsed = parse_messages(texts(spark, f'{{"group":{group}}}'), GROUP_ONLY)
    assert explode_topics(parsed).count() == 0
    with pytest.raises(Exception, match="group without"):
        explode_topics(parsed, strict=True).collect()


def test_duplicate_messages_count_twice_unless_dropped(spark):
    frame = messages(spark, [message([], event_id=1), message([], event_id=1), message([], event_id=2)])
    assert rows(trending.events_count(frame)) == [(3,)]
    parsed = parse_messages(trending.venue_messages(frame))
    assert rows(drop_duplicate_messages(parsed), "event_id") == [("1",), ("2",)]


def test_earliest_duplicate_stays(spark):
    later, first = (message([], response="late"), 60), (message([], response="early"), 0)
    parsed = parse_messages(trending.venue_messages(messages(spark, [later, first])))
    assert rows(drop_duplicate_messages(parsed), "response") == [("early",)]


def test_projection_keeps_absent_null_and_unknown_inner_fields(spark):
    record = {"rsvp_id": 5, "mtime": 9, "guests": 2, "group": {"city": "X"}, "response": "yes"}
    frame = texts(spark, json.dumps(record), json.dumps({**record, "venue": None}))
    values = [json.loads(v) for (v,) in rows(project_records(frame), "value")]
    base = {"event_id": 5, "timestamp": 9, "group": {"city": "X"}, "response": "yes"}
    assert sorted(values, key=len) == [base, {**base, "venue": None}]


def test_projection_takes_the_last_of_repeated_keys(spark):
    frame = project_records(texts(spark, '{"rsvp_id":1,"rsvp_id":2,"mtime":3}'))
    assert rows(frame) == [(2, 3, '{"event_id":2,"timestamp":3}')]


def test_attributes_are_required_strings(spark):
    whole = with_attributes(project_records(texts(spark, '{"rsvp_id":5,"mtime":9}')))
    assert rows(whole, "attributes.event_id", "attributes.timestamp") == [("5", "9")]
    with pytest.raises(Exception, match="record without timestamp"):
        with_attributes(project_records(texts(spark, '{"rsvp_id":5}'))).collect()


def test_encode_keeps_nulls(spark):
    frame = spark.range(1).select(encode_json(F.struct(F.lit(None).cast("int").alias("a"))))
    assert rows(frame) == [('{"a":null}',)]


def test_absent_venue_has_no_topics(spark):
    frame = messages(spark, [message([("a", "A")], venue=ABSENT), message([("b", "B")], venue=None)])
    assert rows(trending.topic_mentions(frame), "topic_key") == [("b",)]


def test_spread_deals_rows_out(spark):
    assert spread(spark.range(10).coalesce(1), 3).rdd.getNumPartitions() == 3


def test_messages_without_an_id_all_stay(spark):
    frame = spark.createDataFrame([(None, "a"), (None, "a"), ("1", "b"), ("1", "b")], "event_id string, publish_ts string")
    assert rows(drop_duplicate_messages(frame)) == sorted([(None, "a"), (None, "a"), ("1", "b")], key=repr)


@pytest.mark.parametrize("text", ['{"venue":1} garbage', '{"venue":1}{"x":2}', '{"venue":1},', '{"venue":1}] x', '{"venue":1}} x'])
def test_text_after_the_object_is_an_error_or_set_aside(spark, text):
    frame = messages(spark, [text, '{"venue":2}'])
    assert rows(trending.events_count(frame)) == [(1,)]
    assert rows(quarantine(decode_messages(frame)), "text") == [(text,)]
    with pytest.raises(Exception, match="malformed message"):
        trending.events_count(frame, strict=True).collect()


def test_unreadable_groups_are_set_aside(spark):
    good = ['{"venue":1,"group":{"group_topics":[]}}', '{"venue":1,"group":{"group_topics":[{"urlkey":"a"}]}}']
    bad = ['{"venue":1}', '{"venue":1,"group":"x"}', '{"venue":1,"group":{}}', '{"venue":1,"group":{"group_topics":[{"urlkey":"a"},7]}}']
    unusable = ['{"venue":', "7"]
    frame = decode_messages(messages(spark, good + bad + unusable))
    assert rows(quarantine_groups(frame), "text") == sorted([(t,) for t in bad], key=repr)
    assert quarantine_groups(frame).columns == frame.columns


def test_opaque_fields_can_be_looked_into(spark):
    frame = texts(
        spark, '{"venue":{"city":{"name":"X"},"id":"7"}}', '{"venue":null}', '{"event":1}', '{"venue":[1]}', '{"venue":5}', "broken",
        '{"venue":{"id":1},"venue":{"id":2,"id":3}}',
    )
    parsed = parse_messages(frame, OPEN_MESSAGE).select("venue")
    found = parsed.select(variant_state(F.col("venue")), at_path(F.col("venue"), "$.id", "int"), at_path(F.col("venue"), "$.city.name", "string"))
    assert [tuple(r) for r in found.collect()] == [
        ("object", 7, "X"), ("null", None, None), ("absent", None, None), ("array", None, None), ("scalar", None, None), ("absent", None, None), ("object", 3, None),
    ]
