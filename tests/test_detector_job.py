"""Every detector in the same exactly-once job: four micro-batches, a death between sink and state, a repeated batch."""

import pytest
from pyspark.sql import functions as F

from flowguard.functions.scalar import epoch_seconds
from flowguard.plans.netflow_autoencoder import NetflowAutoencoder
from flowguard.plans.netflow_forest import NetflowForest
from flowguard.plans.suite.base import Tables
from flowguard.plans.suite.streams import _feed
from flowguard.plans.syslog import SyslogForest, parse_lines
from flowguard.plans.two_view import TwoView
from flowguard.sources.parse import parse_flow
from flowguard.streaming import batches as B

FOLDER = "/root/testdata/sf0.001"


def detectors(spark):
    t = Tables(spark, FOLDER)
    narrow, wide = (parse_flow(t.messages(w), w, keep=["id"]) for w in (48, 71))
    times = parse_lines(t.lines()).select("id", "sec")
    lines = t.lines().join(times, "id")
    flow_sec = epoch_seconds(F.try_to_timestamp("ts"))
    return {
        "forest": (lambda: NetflowForest.fit(narrow, numTrees=10, seed=3), narrow.withColumn("sec", flow_sec), "anomalyScore"),
        "autoencoder": (lambda: NetflowAutoencoder.fit(narrow, hidden=(4,), epochs=1, workers=2), narrow.withColumn("sec", flow_sec), "score"),
        "two_view": (lambda: TwoView.fit(wide, ["...APRS.", "........"], hidden=(4,), epochs=1, workers=2), wide.withColumn("sec", flow_sec), "flow_error"),
        "syslog": (lambda: SyslogForest.fit(t.lines(), numTrees=10, maxSamples=200), lines, "anomalyScore"),
    }


class Dies(RuntimeError):
    pass


@pytest.mark.parametrize("name", ["forest", "autoencoder", "two_view", "syslog"])
def test_equal_to_the_bounded_run_through_a_death(spark, tmp_path, name):
    fit, rows, score = detectors(spark)[name]
    model, path, rows = fit(), str(tmp_path), rows.cache()
    edges = rows.approxQuantile("sec", [0.25, 0.5, 0.75], 0.01)
    cuts = [float("-inf"), *edges, float("inf")]
    parts = [rows.filter((F.col("sec") >= a) & (F.col("sec") < b)) for a, b in zip(cuts, cuts[1:])]
    sink = B.LogSink(spark, f"{path}/verdicts")
    job = B.detector_job(spark, model, f"{path}/context", sink, seconds=600)
    seen, scored = [], model.score
    model.score = lambda frame, **kw: seen.append(1) or scored(frame, **kw)
    write, deaths = job.table.write, [2]

    def dying(batch, frame):
        if batch in deaths:
            deaths.remove(batch)
            raise Dies("after the sink, before the context")
        write(batch, frame)

    job.table.write = dying
    stream = lambda: spark.readStream.schema(rows.schema).parquet(f"{path}/in")
    _feed(parts[:2], f"{path}/in", stream, job, path)
    with pytest.raises(Exception, match="after the sink"):
        _feed(parts[2:3], f"{path}/in", stream, job, path)
    assert sink.has(2) and len(seen) == 3
    B.run_batches(stream(), job, f"{path}/progress").awaitTermination()  # the batch comes back
    assert len(seen) == 3
    _feed(parts[3:], f"{path}/in", stream, job, path)
    assert len(seen) == 4
    value = F.get_json_object(F.col("value").cast("string"), f"$.{score}").cast("double")
    log = spark.read.format("message_log").load(f"{path}/verdicts").select(F.col("key").cast("string").cast("long").alias("id"), value.alias("got"))
    want = scored(rows.drop("is_context")).select("id", F.col(score).alias("want"))
    both = log.join(want, "id", "full").collect()
    assert len(both) == log.count() == want.count() > 100
    assert all(r["got"] == pytest.approx(r["want"], rel=1e-6, abs=1e-9) for r in both)
