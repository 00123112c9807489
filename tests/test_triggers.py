"""The either-or trigger against a replay row by row, in batch and as a stream."""

import datetime as dt
import random
import time

import numpy as np
import pytest
from helpers import START, rows

from tidemark.operators import triggers
from tidemark.operators.triggers import either_panes
from tidemark.streaming.panes import stream_either_panes


def plain_panes(times, every, after, finish=True):
    """(count, fired_by, fired_at) by going through rising times; a row at a deadline opens the next pane."""
    out, held, deadline = [], 0, None
    for i, t in enumerate(times):
        if held and t >= deadline:
            out.append((i, "time", deadline))
            held = 0
        if not held:
            deadline = t + after
        held += 1
        if held == every:
            out.append((i + 1, "count", t))
            held = 0
    return out + [(len(times), "time", deadline)] if held and finish else out


def planted(rng, n):
    return sorted(rng.choice([rng.randrange(5), rng.randrange(60), rng.randrange(900)]) + 40 * rng.randrange(1 + n // 4) for _ in range(n))


@pytest.mark.parametrize("seed", range(60))
def test_slices_put_together_are_the_whole(seed):
    rng = random.Random(seed)
    times, every, after = planted(rng, rng.randrange(1, 80)), rng.choice([1, 2, 3, 5, 17]), rng.choice([1, 7, 30, 400])
    whole, left = triggers.panes_of(np.array(times), every, after)
    assert whole == plain_panes(times, every, after, finish=False)
    cuts = sorted({0, len(times), *(rng.randrange(len(times) + 1) for _ in range(rng.randrange(9)))})
    made, state, told = [], triggers.NOTHING, triggers.NOTHING
    for a, b in zip(cuts, cuts[1:]):
        part = np.array(times[a:b])
        panes, state = triggers.panes_of(part, every, after, state, a)
        made += panes
        at, _ = triggers.entered(part[: every - 1], b - a, every, told)
        if at is None:
            told = (told[0] + b - a, told[1])
        else:
            held, deadlines = triggers.left_open(part, every, after)
            told = (int(held[at]), int(deadlines[at]))
        assert told == state
    assert made == whole and state == left


def _frame(spark, data):
    at = lambda s: None if s is None else START + dt.timedelta(seconds=s)
    return spark.createDataFrame([(k, at(s)) for k, s in data], "k string, at timestamp")


def _expected(data, every, after):
    out = []
    for key in {k for k, _ in data}:
        times = sorted(-(10**9) if s is None else s for k, s in data if k == key)
        fired = lambda s: None if s < -(10**8) else START.replace(tzinfo=None) + dt.timedelta(seconds=s)
        out += [(key, n, by, fired(s)) for n, by, s in plain_panes(times, every, after)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("slice_rows, every, after", [(1 << 16, 2, 30), (7, 2, 30), (7, 5, 90), (3, 11, 400), (1, 1, 5)])
def test_batch_with_a_hot_key_over_many_slices(spark, monkeypatch, slice_rows, every, after):
    monkeypatch.setattr(triggers, "SLICE_ROWS", slice_rows)
    monkeypatch.setattr(triggers, "ROWS_PER_START", 1)
    monkeypatch.setattr(triggers, "MOST_SLICE_ROWS", slice_rows)
    rng = random.Random(every)
    data = [("hot", s) for s in planted(rng, 400)] + [(rng.choice(["a", "b", None]), s) for s in planted(rng, 60)]
    data += [("lost", None), ("lost", None), ("lost", None), ("lost", 5), ("a", None)]
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(max(1, slice_rows // 2)))
    try:
        got = either_panes(_frame(spark, data).repartition(5), ["k"], every, after, "at", name="n")
        assert got.columns == ["k", "n", "fired_by", "fired_at"]
        assert sorted(map(tuple, got.collect()), key=repr) == _expected(data, every, after)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)


def test_batch_without_keys_and_of_nothing(spark):
    data = [(None, s) for s in (0, 10, 25, 100, 129, 130, 131, 500)]
    frame = _frame(spark, data)
    got = rows(either_panes(frame, [], 2, 30, "at"))
    assert got == sorted([r[1:] for r in _expected(data, 2, 30)], key=repr)
    assert either_panes(frame.limit(0), ["k"], 2, 30, "at").count() == 0
    with pytest.raises(ValueError):
        either_panes(frame, [], 0, 30, "at")


def test_keys_may_have_any_name(spark):
    frame = _frame(spark, [("a", 0), ("a", 1)]).selectExpr("k AS times", "1 AS first", "at AS micros")
    assert rows(either_panes(frame, ["times", "first"], 2, 30, "micros"), "times", "running_count", "fired_by") == [("a", 2, "count")]


def test_stream_equals_batch_on_planted_times(spark, tmp_path):
    rng = random.Random(8)
    data = [("hot", s) for s in planted(rng, 120)] + [("a", s) for s in planted(rng, 20)] + [("lone", 3)]
    data.sort(key=lambda r: r[1])
    data.append(("end", 10**6))  # past every deadline but its own
    path = str(tmp_path / "in")
    for at in range(0, len(data), 30):
        _frame(spark, data[at : at + 30]).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)
    source = spark.readStream.schema("k string, at timestamp").option("maxFilesPerTrigger", 1).parquet(path)
    panes = stream_either_panes(source, ["k"], 2, 30, time="at")
    out = str(tmp_path / "out")
    writer = panes.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c"))
    writer.trigger(availableNow=True).start().awaitTermination()
    got = spark.read.schema(panes.schema).parquet(out)
    expected = either_panes(spark.read.schema(source.schema).parquet(path), ["k"], 2, 30, "at").filter("k <> 'end'")
    assert {r.fired_by for r in got.collect()} == {"count", "time"}
    assert rows(got) == rows(expected)
