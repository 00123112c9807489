import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemark.operators import positions
from tidemark.operators.positions import with_positions
from tidemark.operators.ranking import (
    first_by_key,
    largest,
    largest_per_key,
    latest_by_key,
    resort_list,
    smallest,
    smallest_per_key,
    top_n,
    top_n_list,
)
from tidemark.workspace import freeze


@pytest.fixture(scope="module")
def scores(spark):
    data = [("x", "a", 3, 1), ("x", "b", 5, 2), ("x", "c", 5, 3), ("x", "a", 1, 4), ("y", "d", None, 5)]
    return spark.createDataFrame(data, "k string, name string, score int, seq int")


def test_ties_go_by_the_tie_columns(scores):
    top = largest(scores, 2, "score", ties="name")
    assert rows(top, "rank", "name") == [(1, "b"), (2, "c")]


def test_smallest_and_nulls_last(scores):
    assert rows(smallest(scores, 2, "score"), "rank", "score") == [(1, 1), (2, 3)]
    assert rows(smallest(scores, 5, "score", ties="name"), "score")[-1] == (None,)


def test_per_key(scores):
    top = largest_per_key(scores, 1, "score", ["k"], ties="name")
    assert rows(top, "k", "name", "score") == [("x", "b", 5), ("y", "d", None)]
    least = smallest_per_key(scores, 1, "score", ["k"])
    assert rows(least, "k", "score") == [("x", 1), ("y", None)]


def test_derived_key_and_side_argument(scores, spark):
    pivot = spark.createDataFrame([(4,)], "v int").scalar()
    near = smallest(scores, 2, F.abs(F.col("score") - pivot), ties=["name", "seq"])
    assert rows(near, "rank", "name") == [(1, "a"), (2, "b")]


def test_latest_entry_of_a_key_wins_even_with_a_lower_score(scores):
    top = top_n(scores, 3, "score", distinct_on=["name"], seq="seq", ties="name")
    assert rows(top, "rank", "name", "score") == [(1, "b", 5), (2, "c", 5), (3, "a", 1)]
    best = top_n(scores, 3, "score", distinct_on=["name"], ties="name")
    assert rows(best, "rank", "name", "score") == [(1, "b", 5), (2, "c", 5), (3, "a", 3)]


def test_key_returns_when_a_held_one_drops(spark):
    """The ranking is of the latest values, not of what an earlier top held."""
    data = [("a", 9, 1), ("b", 8, 2), ("a", 1, 3)]
    frame = spark.createDataFrame(data, "name string, score int, seq int")
    assert rows(top_n(frame, 1, "score", distinct_on=["name"], seq="seq"), "name") == [("b",)]


def test_order_of_arrival_does_not_matter(spark):
    data = [(f"k{i % 7}", random.Random(i).randint(0, 50), i) for i in range(300)]
    frames = [spark.createDataFrame(d, "name string, score int, seq int") for d in (data, data[::-1])]
    tops = [rows(top_n(f, 3, "score", distinct_on=["name"], seq="seq", ties="name")) for f in frames]
    assert tops[0] == tops[1]


def test_first_and_latest(scores):
    assert rows(latest_by_key(scores, ["name"], "seq").filter("name='a'"), "score") == [(1,)]
    assert rows(first_by_key(scores, ["name"], "seq").filter("name='a'"), "score") == [(3,)]


def test_list_form(scores):
    one = top_n_list(scores, 3, "score", item=F.col("name"), ties="name")
    assert rows(one) == [(["b", "c", "a"],)]
    each = top_n_list(scores, 1, "score", per=["k"], item=F.col("name"), ties="name")
    assert rows(each) == [("x", ["b"]), ("y", ["d"])]
    whole = top_n_list(scores, 1, "score", ties="name").select("top.name", "top.seq")
    assert rows(whole) == [(["b"], [2])]


def test_empty_input(scores):
    nothing = scores.filter("false")
    assert rows(top_n_list(nothing, 3, "score", item=F.col("name"))) == [([],)]
    assert rows(top_n_list(nothing, 3, "score", per=["k"], item=F.col("name"))) == []
    assert rows(top_n(nothing, 3, "score")) == []


def test_arguments_are_checked(scores):
    with pytest.raises(TypeError):
        top_n(scores, 1, "score", compare=None)
    with pytest.raises(ValueError):
        top_n(scores, 0, "score")


def test_comparator_orders_a_list(spark):
    frame = spark.sql("SELECT array('bb', 'a', 'dddd', 'ccc') AS words")
    longest = resort_list(F.col("words"), lambda a, b: F.length(a) < F.length(b))
    assert rows(frame.select(longest)) == [(["dddd", "ccc", "bb", "a"],)]


@pytest.mark.parametrize("n", [3, 150, 1200])
def test_every_n_agrees_with_brute_force_on_a_hot_key(spark, n):
    data = [(9 if i % 3 else i % 5, i * 7919 % 211, i) for i in range(4000)]
    frame = spark.createDataFrame(data, "k int, v int, id int").repartition(6)
    order = sorted(data, key=lambda r: (-r[1], r[2]))
    assert rows(top_n(frame, n, "v", ties="id"), "id") == sorted([(r[2],) for r in order[:n]], key=repr)
    best = [r for k in {r[0] for r in data} for r in [r for r in order if r[0] == k][:n]]
    got = rows(top_n(frame, n, "v", per=["k"], ties="id"), "k", "v", "id")
    assert got == sorted(best, key=repr)


def test_large_n_is_lazy_and_cut_before_the_first_shuffle(spark, tmp_path, monkeypatch):
    """2,000 rows of each of three keys out of 200,000: nothing is written or run to plan it."""
    path = str(tmp_path / "t")
    spark.range(0, 200_000, 1, 4).select((F.col("id") % 3).alias("k"), "id").write.parquet(path)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "no job may run")
    try:
        top = top_n(spark.read.schema("k long, id long").parquet(path), 2000, "id", per=["k"])
        plan = top._jdf.queryExecution().toString()
        assert not tracker.getJobIdsForGroup("planning")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    physical = plan[plan.index("== Physical Plan ==") :]
    last = physical.rindex("Exchange")  # plans are printed from the top down
    assert "WindowGroupLimit" in physical[last:]
    assert physical.count("WindowGroupLimit") >= 4
    best = sorted((i for i in range(200_000)), reverse=True)
    assert sorted(r.id for r in top.collect()) == sorted(i for k in range(3) for i in [x for x in best if x % 3 == k][:2000])


def test_each_map_task_sends_at_most_n_rows_per_group(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select((F.col("id") % 2).alias("k"), "id").write.parquet(path)
    plan = top_n(spark.read.parquet(path), 5, "id", per=["k"])._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert physical.rindex("Exchange") < physical.rindex("WindowGroupLimit")
    assert physical.count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("copies", [False, True])
def test_positions_with_one_hot_key(spark, copies):
    """One key holds nearly all rows; optionally all of them are copies of each other."""
    hot = F.when(F.col("id") % 50 == 0, F.col("id") % 7).otherwise(F.lit(99)).alias("k")
    order = F.lit(1).alias("v") if copies else F.expr("(id * 7919) % 997").alias("v")
    frame = spark.range(0, 20_000, 1, 6).select(hot, order, "id")
    got = with_positions(frame, [F.col("v").desc()], ["k"])
    sizes = {r.k: r.n for r in frame.groupBy("k").agg(F.count("*").alias("n")).collect()}
    seen = {}
    for row in got.orderBy("k", "position").collect():
        seen.setdefault(row.k, []).append((row.position, -row.v))
    assert {k: len(v) for k, v in seen.items()} == sizes
    for numbered in seen.values():
        assert [p for p, _ in numbered] == list(range(1, len(numbered) + 1))
        assert [v for _, v in numbered] == sorted(v for _, v in numbered)


def test_positions_spread_a_hot_key_over_tasks(spark, monkeypatch):
    """Even when every row of it is the same, as far as the order can tell."""
    frozen = []
    monkeypatch.setattr(positions, "freeze", lambda df, label: frozen.append(freeze(df, label)) or frozen[-1])
    frame = spark.range(0, 40_000, 1, 8).select(F.lit(1).alias("k"), F.lit(1).alias("v"), "id")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")  # at this size one task could hold it all
    try:
        numbered = with_positions(frame, [F.col("v")], ["k"])
    finally:
        spark.conf.set(coalesce, "true")
    sizes = [r.n for r in frozen[1].groupBy("_slice").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) > 1 and max(sizes) < 30_000
    assert numbered.agg(F.countDistinct("position"), F.max("position")).first() == (40_000, 40_000)


def test_positions_evaluate_their_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    frame = spark.range(0, 5000, 1, 4).mapInArrow(count, "id long")
    assert with_positions(frame, [F.col("id")]).count() == 5000
    assert seen.value == 5000


def test_positions_with_null_keys(spark):
    frame = spark.createDataFrame([(None, 2), (None, 1), ("a", 5)], "k string, v int")
    got = with_positions(frame, [F.col("v")], ["k"])
    assert rows(got) == sorted([(None, 1, 1), (None, 2, 2), ("a", 5, 1)], key=repr)
