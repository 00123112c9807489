"""A replayed slice is read in as few files as it was written in, but worked on by every core."""

from pyspark.sql import functions as F

from tidemark.registry.queries import _replay


def test_a_replayed_batch_reaches_every_core(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    slices = [spark.range(200).select((F.col("id") + 200 * i).alias("id")) for i in range(2)]
    replay = _replay(spark, *slices)
    seen = []
    query = replay.stream.writeStream.foreachBatch(lambda batch, _: seen.append((batch.rdd.getNumPartitions(), batch.count())))
    query.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    assert [n for _, n in seen if n] == [200, 200]
    assert all(parts >= cores for parts, n in seen if n)
