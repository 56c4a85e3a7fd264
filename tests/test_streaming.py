import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowguard.operators import correlate as C
from flowguard.operators import edges as E
from flowguard.operators.windows import trailing_means
from flowguard.plans.suite.base import Tables
from flowguard.sources import parse, readers, writers
from flowguard.streaming import batches as B
from flowguard.streaming.correlator import correlate_stream

DATA = "/root/testdata/sf0.001"


def files(frame, path, parts, order):
    """Write a frame as consecutive files and stream them one per batch."""
    pdf = frame.toPandas().sort_values(order)
    spark = frame.sparkSession
    for i, part in enumerate(np.array_split(np.arange(len(pdf)), parts)):
        spark.createDataFrame(pdf.iloc[part], frame.schema).coalesce(1).write.mode("append").parquet(str(path))
        time.sleep(1.1)
    return spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(str(path))


def test_look_back_equals_batch(spark, tmp_path):
    flow = Tables(spark, DATA).flow(60).select("id", "sec", "td")
    stream = files(flow, tmp_path / "in", 3, "id")

    def handle(rows, batch_id):
        out = trailing_means(rows, ["td"], (600,)).filter("not is_context").select("id", "td_600_mean")
        out.write.mode("overwrite").parquet(str(tmp_path / f"out/batch={batch_id}"))

    look = B.LookBack(spark, str(tmp_path / "context"), 600, handle)
    B.run_batches(stream, look, str(tmp_path / "check")).awaitTermination(300)
    got = spark.read.parquet(str(tmp_path / "out")).toPandas().sort_values("id")
    want = trailing_means(flow, ["td"], (600,)).toPandas().sort_values("id")
    assert got["batch"].nunique() == 3
    # Rows of a batch cannot see peers of the same second that only arrive with the next batch.
    same = np.isclose(got["td_600_mean"].to_numpy(), want["td_600_mean"].to_numpy())
    assert same.sum() >= len(want) - 10


def test_edge_stream_equals_batch(spark, tmp_path):
    edge = Tables(spark, DATA).flow().select(F.col("id").alias("seq"), F.col("sa").alias("src"), F.col("da").alias("dst"), F.col("sec").alias("epoch"))
    stream = files(edge, tmp_path / "in", 3, "seq")
    cutoffs = spark.createDataFrame([(1, "2024-01-01"), (3, "2024-01-02")], "cutoff long, set_at string")
    job = B.EdgeStream(spark, str(tmp_path / "state"), B.write_each(str(tmp_path / "out")), 7200, cutoffs=cutoffs, cols=64)
    B.run_batches(stream, job, str(tmp_path / "check")).awaitTermination(300)
    got = spark.read.parquet(str(tmp_path / "out")).toPandas().sort_values("seq")
    slotted = E.with_slots(edge, "epoch", 7200, "seq")
    want = E.filtered_burst(slotted, cols=64).toPandas().sort_values("seq")
    np.testing.assert_allclose(got["score"].to_numpy(), want["score"].to_numpy(), rtol=1e-9, atol=1e-9)
    assert (got["is_anomalous"] == (got["score"] > 3)).all()


def results_stream(spark, path, rows):
    schema = "key string, module string, score double, is_anomalous boolean, features string, arrival long"
    frame = spark.createDataFrame(rows, schema)
    frame.coalesce(1).write.mode("append").parquet(str(path))
    return spark.readStream.schema(schema).parquet(str(path))


def wait_for(read, want, seconds=90):
    end = time.time() + seconds
    while time.time() < end:
        rows = read()
        if len(rows) >= want:
            return rows
        time.sleep(1)
    return read()


def test_correlator_completion_timeout_and_repeats(spark, tmp_path):
    rows = [
        ("a", "MIDAS", 1.0, True, "", 1), ("a", "IFOREST", 0.6, False, "f1", 2), ("a", "MIDAS", 9.0, False, "", 3),
        ("b", "MIDAS", 2.0, True, "", 4), ("b", "MIDAS", 7.0, True, "", 5), ("c", "AE", 0.1, False, "f2", 6),
        ("d", "WHAT", 0.1, True, "", 7),
    ]
    stream = results_stream(spark, tmp_path / "in", rows)
    fused = correlate_stream(stream, rule="MIDAS_IFOREST", timeout_ms=2000)
    query = (
        fused.writeStream.format("memory").queryName("fused_rows").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "check")).trigger(processingTime="1 second").start()
    )
    try:
        # a completes at once, then its repeated MIDAS result opens a fresh group that is quiet; b times out; c has no flag.
        got = {(r["key"], r["reason"]): r for r in wait_for(lambda: spark.sql("select * from fused_rows").collect(), 2)}
    finally:
        query.stop()
    assert set(got) == {("a", "complete"), ("b", "timeout")}
    assert got["a", "complete"]["midas"]["score"] == 1.0 and got["a", "complete"]["iforest"]["features"] == "f1"
    assert got["b", "timeout"]["midas"]["score"] == 2.0 and got["b", "timeout"]["ae"] is None


def test_correlator_equals_batch_fusion(spark, tmp_path):
    results = Tables(spark, DATA).results().drop("sa")
    results.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(results.schema).parquet(str(tmp_path / "in"))
    fused = correlate_stream(stream, rule="ALL", timeout_ms=2000, late="drop")
    query = (
        fused.writeStream.format("memory").queryName("fused_all").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "check")).trigger(processingTime="1 second").start()
    )
    want = C.fuse(results).filter(C.shall_propagate()).select("key", "midas", "ae", "iforest", "first_arrival").toPandas()
    try:
        rows = wait_for(lambda: spark.sql("select * from fused_all").collect(), len(want))
    finally:
        query.stop()
    got = pd.DataFrame([r.asDict(recursive=True) for r in rows])
    assert sorted(got["key"]) == sorted(want["key"])
    assert got.set_index("key")["first_arrival"].to_dict() == want.set_index("key")["first_arrival"].to_dict()


def test_records_round_trip(spark, tmp_path):
    """Messages to files and back with the record schema of the broker."""
    messages = writers.keyed_messages(Tables(spark, DATA).messages(48), "value", "id", "demo-message-")
    records = messages.select(
        F.col("key").cast("binary"), F.col("value").cast("binary"), F.lit("flows").alias("topic"), F.lit(0).alias("partition"),
        F.substring_index("key", "-", -1).cast("long").alias("offset"), F.current_timestamp().alias("timestamp"),
    )
    writers.write_messages(records, "parquet", str(tmp_path / "topic"))
    back = readers.read_records(spark, "parquet", str(tmp_path / "topic"))
    n = back.count()
    assert B.high_water(back) == '{"flows": {"0": %d}}' % n
    assert parse.parse_flow(parse.decode(readers.since_offset(back, n - 5)), 48).count() == 5
    stream = readers.stream_records(spark, "parquet", str(tmp_path / "topic"))
    query = stream.writeStream.format("memory").queryName("replayed").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert spark.table("replayed").count() == n


def test_repeats_within_watermark(spark, tmp_path):
    rows = [(i % 5, f"2024-01-01 00:00:{i:02d}") for i in range(20)]
    frame = spark.createDataFrame(rows, "v int, t string").select("v", F.col("t").cast("timestamp").alias("timestamp"))
    frame.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in"))
    query = (
        B.without_repeats(stream, ["v"]).writeStream.format("memory").queryName("uniques").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    assert sorted(r["v"] for r in spark.table("uniques").collect()) == [0, 1, 2, 3, 4]


def test_kafka_options():
    assert readers.kafka_options("b:1", "t", partition=3, start=40) == {
        "kafka.bootstrap.servers": "b:1", "failOnDataLoss": "false", "assign": '{"t": [3]}', "startingOffsets": '{"t": {"3": 40}}',
    }
    assert readers.kafka_options("b:1", "t", group="g")["startingOffsets"] == "latest"
    assert readers.kafka_options("b:1", "t", start="earliest")["subscribe"] == "t"


def test_cutoff_store(spark, tmp_path):
    for value in (5, 9):
        B.store_cutoff(spark.createDataFrame([(value,)], "cutoff long"), str(tmp_path / "cut"))
        time.sleep(0.05)
    assert B.current_cutoff(spark.read.parquet(str(tmp_path / "cut"))).first()["cutoff"] == 9


def test_tenant_folders(spark, tmp_path):
    frame = spark.range(10).select(F.concat(F.lit("t"), (F.col("id") % 2).cast("string")).alias("tenant_id"), "id")
    writers.write_by_tenant(frame, str(tmp_path / "x"))
    plan = spark.read.parquet(str(tmp_path / "x")).filter("tenant_id = 't1'")
    assert plan.count() == 5 and "PartitionFilters: [isnotnull(tenant_id" in plan._jdf.queryExecution().toString()
