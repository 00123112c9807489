"""Exact de-duplication with an index of all ids, against a set."""

import random

import pytest
from helpers import rows

from tidemark.streaming.seen import SeenIds
from tidemark.streaming.store import Commits

SCHEMA = "k string, at int, note string"


def _run(spark, seen, data, version):
    return seen.first_seen(spark.createDataFrame(data, SCHEMA).repartition(3), version, "k", ["at", "note"])


def test_every_id_once_over_many_batches(spark, tmp_path):
    rng, known = random.Random(6), set()
    seen = SeenIds(spark, str(tmp_path), buckets=4, fan=3)
    for version in range(14):
        data = [(rng.choice([None, *map(str, range(60 + 9 * version))]), rng.randrange(9), f"n{i}") for i in range(40)]
        expected = [r for r in data if r[0] is None]
        for k in {r[0] for r in data} - known - {None}:
            expected.append(min((r for r in data if r[0] == k), key=lambda r: (r[1], r[2])))
        got = _run(spark, seen, data, version)
        assert got.columns == ["k", "at", "note"] and rows(got) == sorted(expected, key=repr)
        if version % 5 == 4:  # the batch is run again
            assert rows(_run(spark, seen, data, version)) == sorted(expected, key=repr)
        known |= {r[0] for r in data} - {None}
    parts = [part for _, part, _ in seen._entries(seen.commits.newest())]
    assert len({p.rsplit("-", 1)[0] for p in parts}) <= 2 * 3  # runs stay few: two a level
    stored = seen._read(seen._entries(seen.commits.newest())).selectExpr("explode(ids) AS id")
    assert sorted(r.id for r in stored.collect()) == sorted(known)


def test_files_read_are_in_proportion_to_the_batch(spark, tmp_path):
    seen = SeenIds(spark, str(tmp_path), buckets=16, fan=4)
    for version in range(3):
        _run(spark, seen, [(f"{version}-{i}", 0, "x") for i in range(400)], version)
    _run(spark, seen, [("new", 0, "x")], 3)
    filters, ids = seen.files_read
    assert filters <= 3 and ids == 0
    assert rows(_run(spark, seen, [("1-7", 9, "late"), ("newer", 9, "y")], 4), "k") == [("newer",)]
    filters, ids = seen.files_read
    assert filters <= 4 and ids <= 1


def test_a_batch_killed_before_its_commit_has_seen_nothing(spark, tmp_path, monkeypatch):
    seen = SeenIds(spark, str(tmp_path), buckets=2)
    _run(spark, seen, [("a", 0, "x")], 0)
    monkeypatch.setattr(Commits, "commit", lambda *a, **b: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        _run(spark, seen, [("a", 1, "x"), ("b", 1, "x")], 1)
    monkeypatch.undo()
    again = SeenIds(spark, str(tmp_path), buckets=2)
    assert rows(_run(spark, again, [("a", 1, "x"), ("b", 1, "x")], 1), "k") == [("b",)]
    assert rows(_run(spark, again, [("a", 1, "x"), ("b", 1, "x")], 2), "k") == []


def test_odd_batches(spark, tmp_path):
    seen = SeenIds(spark, str(tmp_path), buckets=2)
    assert _run(spark, seen, [], 0).count() == 0
    assert _run(spark, seen, [(None, 1, "x"), (None, 1, "x")], 1).count() == 2
    odd = spark.createDataFrame([(1, 2, 3), (1, 1, 4)], "_bucket int, seen_id int, _nameless int")
    assert rows(seen.first_seen(odd, 2, "_bucket", ["seen_id"])) == [(1, 1, 4)]
    assert seen.first_seen(odd, 3, "_bucket", ["seen_id"]).count() == 0
