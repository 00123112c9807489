"""Top-N under comparators in Python, against sorting everything."""

import random
import sys
from functools import cmp_to_key

import pytest
from helpers import rows
from pyspark import cloudpickle

from tidemark.operators import comparing
from tidemark.operators.comparing import top_n_compared


cloudpickle.register_pickle_by_value(sys.modules[__name__])


def joined_less(a, b):
    """By which of the two texts in a row reads smaller: no order of single values."""
    return a["text"] + b["text"] < b["text"] + a["text"]


def plain_top(data, n, reverse=False):
    def compare(a, b):
        x, y = a[1] + b[1], b[1] + a[1]
        if x != y:
            return (-1 if x < y else 1) * (1 if reverse else -1)
        return (a[2] > b[2]) - (a[2] < b[2])

    out = []
    for key in {r[0] for r in data}:
        best = sorted((r for r in data if r[0] == key), key=cmp_to_key(compare))[:n]
        out += [(*r, i + 1) for i, r in enumerate(best)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def data():
    rng = random.Random(2)
    hot = [("hot", str(rng.randrange(2000)), i) for i in range(1500)]
    return hot + [(rng.choice(["a", "b", None]), rng.choice("19") * rng.randrange(1, 4), 2000 + i) for i in range(80)]


@pytest.mark.parametrize("n, reverse", [(1, False), (7, True), (40, False)])
def test_best_rows_of_each_key(spark, data, monkeypatch, n, reverse):
    monkeypatch.setattr(comparing, "MOST_HELD", 50)
    monkeypatch.setattr(comparing, "FAN_IN", 2)
    frame = spark.createDataFrame(data, "k string, text string, id int").repartition(9)
    got = top_n_compared(frame, n, joined_less, per=["k"], reverse=reverse, ties=["id"])
    assert got.columns == ["k", "text", "id", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_top(data, n, reverse)


def test_best_rows_of_all(spark, data):
    frame = spark.createDataFrame([("x", *r[1:], 0) for r in data], "k string, text string, id int, rank int").repartition(4)
    got = top_n_compared(frame, 10, joined_less, ties=["id"])
    assert sorted(map(tuple, got.collect()), key=repr) == plain_top([("x", *r[1:]) for r in data], 10)


def test_each_map_task_sends_few_rows(spark):
    sent = spark.sparkContext.accumulator(0)

    def watched(batches):
        for batch in batches:
            sent.add(batch.num_rows)
            yield batch

    frame = spark.range(0, 20_000, 1, 4).selectExpr("id % 2 AS k", "cast(id AS string) AS text", "id")
    best = frame.mapInArrow(comparing._best_of_task(["k"], 3, comparing._comparison(joined_less, False, ["id"])), frame.schema)
    assert best.mapInArrow(watched, best.schema).count() == 4 * 2 * 3 == sent.value


def test_odd_input(spark, data):
    frame = spark.createDataFrame(data[:5], "k string, text string, id int")
    assert top_n_compared(frame.limit(0), 3, joined_less, per=["k"]).count() == 0
    with pytest.raises(ValueError):
        top_n_compared(frame, 0, joined_less)
    typed = spark.sql("SELECT 1 AS _share, timestamp'2024-01-01 00:00:00' AS at, map('a', 1) AS m, CAST(1.5 AS decimal(9,2)) AS d")
    assert rows(top_n_compared(typed, 1, lambda a, b: a["d"] < b["d"], per=["_share"]).drop("m")) == rows(typed.drop("m").selectExpr("*", "1 AS rank"))
