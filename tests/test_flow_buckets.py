"""Correlation by event time with many flows in a bucket: few calls of the state store, and as few state partitions as asked for."""

import os

from pyspark.sql import Row
from pyspark.sql import functions as F

from flowguard.streaming import batches as B
from flowguard.streaming.correlator import EventTimeCorrelator, correlate_stream


class Store:
    """A handle and its values, which count the calls."""

    def __init__(self):
        self.calls, self.values, self.timers = 0, {}, set()

    def getValueState(self, name, schema):
        store = self

        class Value:
            def get(self):
                store.calls += 1
                return store.values.get(name)

            def update(self, value):
                store.calls += 1
                store.values[name] = value

            def clear(self):
                store.calls += 1
                store.values.pop(name, None)

        return Value()

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)


class Clock:
    def __init__(self, at):
        self.at = at

    getCurrentWatermarkInMs = getExpiryTimeInMs = lambda self: self.at


def test_flows_of_a_bucket_share_their_calls():
    store = Store()
    bucket = EventTimeCorrelator("MIDAS_IFOREST", 10_000, "drop", only_anomalous=False)
    bucket.init(store)
    rows = [Row(key=k, module=m, score=1.0, is_anomalous=True, features="f", arrival=at, flow=None, at=None, us=at * 1000)
            for n in range(300) for k in [None if n == 0 else f"k{n}"] for m, at in [("MIDAS", 1_000 + n), ("IFOREST", 2_000 + n)][: 1 + n % 2]]
    sent = list(bucket.handleInputRows((7,), iter(rows), None))
    assert sorted(r.key for r in sent) == sorted(f"k{n}" for n in range(1, 300, 2)) and {r.reason for r in sent} == {"complete"}
    assert store.calls <= 5 and store.timers == {11_001}
    assert not list(bucket.handleInputRows((7,), iter(rows), None))  # closed flows and known results
    # The timer of the first open flow closes what is over by the watermark and is set anew for what is next.
    fired = list(bucket.handleExpiredTimer((7,), Clock(11_101), Clock(11_001)))
    assert sorted(str(r.key) for r in fired) == sorted(str(None if n == 0 else f"k{n}") for n in range(0, 100, 2)) and {r.reason for r in fired} == {"timeout"}
    assert max(store.timers) == 11_101 and store.calls <= 14
    assert len(list(bucket.handleExpiredTimer((7,), Clock(50_000), Clock(11_101)))) == 100
    assert not store.values and not store.timers - {11_001, 11_101}  # nothing is left to time


def test_state_has_the_partitions_asked_for(spark, tmp_path):
    path, usual = str(tmp_path), spark.conf.get("spark.sql.shuffle.partitions")
    rows = spark.range(40).select(
        F.col("id").cast("string").alias("key"), F.lit("AE").alias("module"), F.lit(1.0).alias("score"), F.lit(True).alias("is_anomalous"), F.lit("f").alias("features"),
        F.col("id").alias("arrival"), F.timestamp_seconds(F.col("id") + 100).alias("at"))
    rows.write.parquet(f"{path}/in")
    fused = correlate_stream(spark.readStream.schema(rows.schema).parquet(f"{path}/in"), time="at", timeout_ms=10_000, buckets=5)
    B.run_batches(fused, B.write_each(f"{path}/out"), f"{path}/progress", partitions=3).awaitTermination()
    assert sorted(x for x in os.listdir(f"{path}/progress/state/0") if x.isdigit()) == ["0", "1", "2"]
    assert spark.conf.get("spark.sql.shuffle.partitions") == usual and B.state_partitions(spark) <= max(8, spark.sparkContext.defaultParallelism)
    # The watermark is at 139 s: flows whose time-out lies before it are out, the others stay open.
    assert sorted(int(r.key) for r in spark.read.parquet(f"{path}/out").collect()) == list(range(29))
    assert spark.read.format("statestore").option("stateVarName", "results").load(f"{path}/progress").count() <= 5
