"""Rankings kept up under scores that fall, against the ranking of the latest scores."""

import random
import time

import pytest
from helpers import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.ranking import top_n
from tidemark.streaming import rankings
from tidemark.streaming.rankings import Ranking, stream_top_n

SCHEMA = "w string, k string, score long, seq long"


class _State:
    """A state variable held in memory."""

    def __init__(self):
        self.value, self.map = None, {}

    def exists(self):
        return self.value is not None

    def get(self):
        return iter(self.value) if isinstance(self.value, list) else self.value

    def update(self, value):
        self.value = tuple(value)

    def put(self, value):
        self.value = list(value)

    def clear(self):
        self.value = None

    def containsKey(self, key):
        return key in self.map

    def getValue(self, key):
        return self.map[key]

    def updateValue(self, key, value):
        self.map[key] = value

    def iterator(self):
        self.scans = getattr(self, "scans", 0) + 1
        return iter(self.map.items())


@pytest.mark.parametrize("seed", range(40))
def test_every_batch_ends_as_the_latest_scores_rank(seed):
    import pandas as pd

    rng, n = random.Random(seed), random.Random(seed).choice([1, 3, 10])
    ranking = Ranking(["w"], n)
    ranking.latest, ranking.top, ranking.bound, ranking.revision = (_State() for _ in range(4))
    latest, shown, seq = {}, [], 0
    for _ in range(60):
        batch = []
        for _ in range(rng.randrange(1, 6)):
            seq += 1
            name, score = f"k{rng.randrange(30)}", rng.choice([rng.randrange(5), rng.randrange(100)])
            at = seq - rng.choice([0, 0, 0, 40])  # some rows come after newer ones
            batch.append((name, score, at))
            if name not in latest or (at, score) > latest[name]:
                latest[name] = (at, score)
        for frame in ranking.handleInputRows(("x",), iter([pd.DataFrame(batch, columns=["key", "score", "seq"])]), None):
            shown = list(zip(frame["key"], frame["score"]))
        expected = sorted(((k, s) for k, (_, s) in latest.items()), key=lambda e: (-e[1], e[0]))[:n]
        assert shown == expected
    assert ranking.latest.scans < 50


def test_stream_equals_batch(spark, tmp_path):
    rng = random.Random(4)
    data = [(rng.choice(["a", "b", None]), f"k{rng.randrange(12)}", rng.randrange(50), i) for i in range(400)]
    data += [("a", None, 1, 1), ("a", "k1", None, 999), ("a", "k1", 70, None)]
    path = str(tmp_path / "in")
    for at in range(0, len(data), 80):
        spark.createDataFrame(data[at : at + 80], SCHEMA).coalesce(2).write.mode("append").parquet(path)
        time.sleep(0.05)
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 2).parquet(path)
    ranked = stream_top_n(source, 3, per=["w"], key="k", score="score", seq="seq")
    out = str(tmp_path / "out")
    writer = ranked.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c"))
    writer.trigger(availableNow=True).start().awaitTermination()
    got = spark.read.schema(ranked.schema).parquet(out)
    newest = got.withColumn("last", F.max("revision").over(Window.partitionBy("w"))).filter("revision = last")
    whole = spark.createDataFrame(data[:400], SCHEMA)
    expected = top_n(whole, 3, "score", per=["w"], distinct_on=["k"], seq="seq", ties="k")
    assert rows(newest, "w", "rank", "k", "score") == rows(expected, "w", "rank", "k", "score")
    assert got.filter("w = 'a'").agg(F.max("revision")).first()[0] > 1
    with pytest.raises(ValueError):
        rankings.stream_top_n(source, 0, per=[], key="k", score="score", seq="seq")
