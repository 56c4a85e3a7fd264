"""The offset-addressed log: bounds, filters, resumed streams, loss, and writes that count once."""

import json

import pytest
from pyspark.sql import functions as F

from flowguard.sources import message_log as L


@pytest.fixture
def log(spark, tmp_path):
    """Three commits to three partitions; partition p holds values p:0, p:1, ... at offsets 0, 1, ..."""
    L.register(spark)
    path = str(tmp_path / "log")
    for batch, (low, high) in enumerate([(0, 300), (300, 310), (310, 700)]):
        rows = spark.range(low, high, 1, 1).select(F.col("id").cast("string").cast("binary").alias("key"), F.concat((F.col("id") % 3).cast("string"), F.lit(":"), F.floor(F.col("id") / 3).cast("string")).cast("binary").alias("value"),
                                                  (F.col("id") % 3).cast("int").alias("partition"), F.timestamp_seconds("id").alias("timestamp"))
        rows.write.format("message_log").option("batch", batch).option("topic", "flows").mode("append").save(path)
    return path


def read(spark, path, **options):
    return spark.read.format("message_log").options(**options).load(path)


def listed(df):
    rows = df.select("topic", "partition", "offset", F.col("value").cast("string").alias("v")).collect()
    assert all(r["topic"] == "flows" and r["v"] == f"{r['partition']}:{r['offset']}" for r in rows)
    return sorted((r["partition"], r["offset"]) for r in rows)


def test_bounds_inside_partitions(spark, log):
    assert listed(read(spark, log)) == [(p, o) for p in range(3) for o in range(234 if p == 0 else 233)]
    some = read(spark, log, startingOffsets='{"flows": {"0": 40, "1": 99, "2": 101}}', endingOffsets='{"flows": {"0": 45, "1": 105, "2": 101}}', rowsPerTask="3")
    assert listed(some) == [(0, o) for o in range(40, 45)] + [(1, o) for o in range(99, 105)]
    assert some.rdd.getNumPartitions() > 3
    assert listed(read(spark, log, assign='{"flows": [2]}', startingOffsets='{"flows": {"2": 230}}')) == [(2, 230), (2, 231), (2, 232)]
    assert listed(read(spark, log, startingOffsets="latest")) == []
    assert listed(read(spark, log, startingOffsets="latest", lookBack="2", assign='{"flows": [0]}')) == [(0, 232), (0, 233)]
    assert read(spark, log).filter("partition = 1").agg(F.min("timestamp"), F.max(F.col("key").cast("string").cast("int"))).first()[1] == 697


def test_filters_reach_the_files(spark, log):
    some = read(spark, log).filter("partition IN (0, 1) AND offset >= 100 AND offset < 104 AND value IS NOT NULL")
    assert listed(some) == [(p, o) for p in (0, 1) for o in range(100, 104)]
    reader = L.LogReader({"path": log})
    left = list(reader.pushFilters([L.EqualTo(("partition",), 1), L.GreaterThan(("offset",), 50), L.LessThanOrEqual(("offset",), 52), L.EqualTo(("key",), b"1")]))
    assert [f.attribute for f in left] == [("key",)]
    assert [(p.partition, p.offset, p.count) for p in reader.partitions()] == [(1, 51, 2)]


def test_loss_policy(spark, log):
    L.Log(log).expire({("flows", 0): 100, ("flows", 1): 102})
    assert {k: b[0] for k, b in L.Log(log).bounds().items()} == {("flows", 0): 100, ("flows", 1): 100, ("flows", 2): 0}
    assert listed(read(spark, log, startingOffsets='{"flows": {"0": 5}}', failOnDataLoss="false", assign='{"flows": [0]}'))[0] == (0, 100)
    with pytest.raises(Exception, match="are gone"):
        read(spark, log, startingOffsets='{"flows": {"0": 5}}').count()
    assert listed(read(spark, log, assign='{"flows": [0]}'))[0] == (0, 100)


def test_streams_resume_where_they_stopped(spark, log, tmp_path):
    def run(**options):
        stream = spark.readStream.format("message_log").options(assign='{"flows": [0, 2]}', **options).load(log)
        query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start(str(tmp_path / "out"))
        query.awaitTermination(120)
        assert query.exception() is None
        return listed(spark.read.parquet(str(tmp_path / "out")))

    first = run(startingOffsets='{"flows": {"0": 200, "2": 210}}')
    assert first == [(0, o) for o in range(200, 234)] + [(2, o) for o in range(210, 233)]
    assert run(startingOffsets="earliest") == first  # nothing new
    more = spark.range(6).select(F.concat(F.lit("2:"), (F.col("id") + 233).cast("string")).cast("binary").alias("value"), F.lit(2).alias("partition")).coalesce(1)
    more.write.format("message_log").option("topic", "flows").option("batch", 99).mode("append").save(log)
    assert run(startingOffsets="earliest") == first + [(2, o) for o in range(233, 239)]


def test_triggers_are_bounded(spark, log, tmp_path):
    sizes = []
    stream = spark.readStream.format("message_log").options(maxOffsetsPerTrigger="100", startingOffsets='{"flows": {"0": 230}}').load(log)
    query = stream.writeStream.foreachBatch(lambda df, i: sizes.append(df.count())).option("checkpointLocation", str(tmp_path / "check")).trigger(processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
        more = spark.range(250).select(F.lit(b"x").alias("value"), F.lit(1).alias("partition"))
        more.write.format("message_log").option("topic", "flows").mode("append").save(log)
        query.processAllAvailable()
    finally:
        query.stop()
    # The first micro-batch takes what is there, later ones no more than they may.
    assert sizes == [4 + 233 + 233, 100, 100, 50]


def test_writes_count_once_or_not_at_all(spark, log, tmp_path):
    before = listed(read(spark, log))
    rows = spark.range(5).select(F.lit(b"x").alias("value"))
    rows.write.format("message_log").option("topic", "flows").option("batch", 1).mode("append").save(log)  # known
    assert listed(read(spark, log)) == before

    def fails(batches):
        for i, b in enumerate(batches):
            yield b
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        spark.range(100, numPartitions=4).mapInArrow(fails, "id long").select(F.lit(b"x").alias("value")).write.format("message_log").option("batch", 50).mode("append").save(log)
    assert listed(read(spark, log)) == before and not L.Log(log).has("50")
    used = {s["file"] for s in L.Log(log).segments()}
    assert len(used) == 9


def test_streaming_writer_repeats_a_batch_without_a_trace(spark, log, tmp_path):
    target = str(tmp_path / "copy")

    def run():
        stream = spark.readStream.format("message_log").load(log).select("value", "partition", "timestamp", F.lit("flows").alias("topic"))
        query = stream.writeStream.format("message_log").option("path", target).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
        query.awaitTermination(120)
        assert query.exception() is None

    run()
    got = read(spark, target).count()
    assert got == 700
    commits = tmp_path / "check" / "commits"
    for f in commits.iterdir():  # as if the driver had died after the sink took the batch and before Spark noted it
        f.unlink()
    run()
    assert read(spark, target).count() == 700 and json.loads((tmp_path / "copy" / "commits").iterdir().__next__().read_text())
