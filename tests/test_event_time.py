"""Correlation by event time: no clock, no waiting, and the same flows however the results are cut into batches."""

import pandas as pd
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from flowguard.plans import aggregator
from flowguard.plans.suite import jobs, streams
from flowguard.plans.suite.base import Tables
from flowguard.sources.writers import OrdinalSink
from flowguard.streaming import batches as B
from flowguard.streaming.correlator import correlate_stream

FOLDER = "/root/testdata/sf0.001"
RESULTS = "key string, module string, score double, is_anomalous boolean, features string, arrival long, flow string, s long"


def fuse(spark, path, batches, **options):
    """Each batch is one run of the stream; returns (key, reason, midas score, iforest score, first_arrival, flow) rows."""
    frames = [spark.createDataFrame(b, RESULTS).withColumn("at", F.timestamp_seconds("s")) for b in batches]

    def stream():
        rows = spark.readStream.schema(frames[0].schema).parquet(f"{path}/in")
        return correlate_stream(rows, time="at", **{"rule": "MIDAS_IFOREST", "timeout_ms": 10_000, "late": "drop", "only_anomalous": False, **options})

    streams._feed(frames, f"{path}/in", stream, B.write_each(f"{path}/out"), path)
    out = spark.read.parquet(f"{path}/out")
    return sorted(map(tuple, out.select("key", "reason", "midas.score", "iforest.score", "first_arrival", "flow").collect()), key=str)


def row(key, module, score, s, flow="f"):
    return (key, module, score, False, "", s, flow, s)


ROWS = [
    row("a", "MIDAS", 1.0, 100, "first"), row("b", "MIDAS", 2.0, 101), row("a", "IFOREST", 3.0, 105, "second"), row("a", "MIDAS", 9.0, 106), row("c", "AE", 1.0, 107),
    row("b", "IFOREST", 4.0, 112), row("a", "MIDAS", 5.0, 115), row("a", "IFOREST", 6.0, 116), row("b", "MIDAS", 7.0, 122), row("b", "IFOREST", 8.0, 123), row("x", "NONE", 0.0, 1000),
]
# a completes at 105 and stays closed up to 115; 116 opens it again. b times out at 111, stays closed up to 121, and completes later.
WANT = sorted([("a", "complete", 1.0, 3.0, 100, "first"), ("a", "timeout", None, 6.0, 116, "f"), ("b", "timeout", 2.0, None, 101, "f"),
               ("b", "complete", 7.0, 8.0, 122, "f"), ("c", "timeout", None, None, 107, "f")], key=str)


@pytest.mark.parametrize("cuts", [[10], [1, 3, 4, 10], list(range(1, 11))])
def test_cuts_do_not_matter(spark, tmp_path, cuts):
    assert fuse(spark, str(tmp_path), [ROWS[a:b] for a, b in zip([0, *cuts], [*cuts, len(ROWS)])]) == WANT


def test_reopening_and_delay(spark, tmp_path):
    rows = [row("a", "MIDAS", 1.0, 100), row("a", "IFOREST", 2.0, 101), row("a", "IFOREST", 3.0, 102), row("a", "MIDAS", 4.0, 103)]
    got = fuse(spark, str(tmp_path / "re"), [rows, [row("x", "NONE", 0.0, 1000)]], late="reopen")
    assert [(g[1], g[2], g[3]) for g in got] == [("complete", 1.0, 2.0), ("complete", 4.0, 3.0)]
    late = [[row("a", "IFOREST", 2.0, 108)], [row("a", "MIDAS", 1.0, 104)], [row("x", "NONE", 0.0, 1000)]]
    assert [g[1] for g in fuse(spark, str(tmp_path / "none"), late)] == ["timeout"]  # behind the watermark
    assert [g[1] for g in fuse(spark, str(tmp_path / "some"), late, delay="5 seconds")] == ["complete"]


def test_state_goes_when_nothing_is_open(spark, tmp_path):
    path = str(tmp_path)
    fuse(spark, path, [ROWS, [row("y", "NONE", 0.0, 5000)], [row("z", "NONE", 0.0, 9000)]])
    state = spark.read.format("statestore").option("stateVarName", "results").load(f"{path}/progress")
    shut = spark.read.format("statestore").option("stateVarName", "shut").load(f"{path}/progress")
    assert state.count() == 0 and shut.count() == 0


@pytest.mark.parametrize("parts", [1, 5])
def test_query_is_the_same_for_every_release(spark, tmp_path, parts):
    t = Tables(spark, FOLDER)
    got = {r["key"]: (r["reason"], r["midas"] and r["midas"]["score"]) for r in streams.correlated(t, parts, str(tmp_path)).collect()}
    key = F.concat(F.col("user_id").cast("string"), F.lit("|"), F.date_format("ts", "yyyy-MM-dd"))
    want = t("events").groupBy(key.alias("key")).agg(
        F.min_by(F.when(F.col("event_type") == "click", F.col("value")), F.when(F.col("event_type") == "click", F.col("ts"))).alias("midas"),
        (F.max(F.col("event_type") == "click") & F.max(F.col("event_type") == "error")).alias("both"))
    assert got == {r["key"]: ("complete" if r["both"] else "timeout", r["midas"]) for r in want.collect()}


def test_streamed_lines_equal_the_batch_job(spark, tmp_path):
    """Fused lines of the stream, numbered over micro-batches, are those of the bounded aggregator."""
    t, path = Tables(spark, FOLDER), str(tmp_path)
    messages = jobs._result_messages(t).join(t("events").select(F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("at")), "id")
    day = F.dayofyear("at")
    end = messages.orderBy(F.desc("at")).limit(1).withColumn("at", F.expr("at + INTERVAL 90 DAYS")).withColumn("id", F.lit(10**6).cast("long"))
    parts = [messages.filter(day <= 10), messages.filter((day > 10) & (day <= 20)), messages.filter(day > 20), end]
    sink = OrdinalSink(B.VersionedTable(spark, f"{path}/marks"), B.write_each(f"{path}/out"), "line", "first_arrival", aggregator.PREFIX)

    def stream():
        rows = spark.readStream.schema(messages.schema).parquet(f"{path}/in")
        return aggregator.aggregate_stream(rows, time="at", late="drop", only_anomalous=False, timeout_ms=40 * 86_400_000)

    streams._feed(parts, f"{path}/in", stream, lambda frame, batch: sink(aggregator.fused_lines(frame), batch), path)
    got = spark.read.parquet(f"{path}/out").toPandas()
    want = aggregator.aggregate(messages.select("id", "value")).toPandas()
    column = "value" if "value" in got.columns else "line"
    assert sorted(got[column]) == sorted(want["value"]) and len(got) > 50
    assert sorted(got["key"]) == sorted(want["key"])


def test_a_flow_costs_few_calls_of_the_state_store():
    """Every call is a message to the JVM and back, and there are about as many flows as rows."""
    from flowguard.streaming.correlator import EventTimeCorrelator

    calls = []

    class Handle:
        def __getattr__(self, name):
            return (lambda *_: State()) if name.startswith("get") else lambda *_: calls.append(name) or []

    class State:
        value = None

        def get(self):
            calls.append("get")
            return self.value

        def update(self, value):
            calls.append("update")
            self.value = value

        def clear(self):
            self.update(None)

    flow = EventTimeCorrelator("MIDAS_IFOREST", 10_000, "drop", only_anomalous=False)
    flow.init(Handle())
    columns = dict(key="a", score=1.0, is_anomalous=True, features="f", flow=None)
    batches = [[("MIDAS", 1_000)], [("MIDAS", 2_000), ("AE", 3_000)], [("IFOREST", 4_000)], [("IFOREST", 5_000)]]
    sent = []
    for batch in batches:
        calls.clear()
        rows = [Row(module=m, arrival=at, us=at * 1000, at=pd.Timestamp(at, unit="ms"), **columns) for m, at in batch]
        for out in flow.handleInputRows(("a",), iter(rows), None):
            sent.append((out.reason, out.first_arrival, out.ae.features))
        assert len(calls) <= 5
    assert sent == [("complete", 1_000, "f")]
