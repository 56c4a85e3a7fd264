"""Cutoffs learned from quantile sketches over micro-batches."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowguard.operators import edges as E
from flowguard.plans.suite.base import Tables
from flowguard.streaming import batches as B
from flowguard.streaming.cutoffs import MOST_K, CutoffSketches, sketch_size


def test_merged_quantiles_are_within_the_rank_error(spark, tmp_path):
    rng = np.random.default_rng(0)
    q, error = 0.99, 0.004
    sketches = CutoffSketches(spark, str(tmp_path), ["tenant"], q=q, error=error)
    past = {0: [], 1: []}
    assert sketches.cutoffs(0) is None
    for batch in range(5):
        values = {0: rng.lognormal(5, 2, 30_000), 1: np.sort(rng.normal(1e6, 1e5, 2000))}
        if batch == 3:
            values[0] = np.zeros(0)  # a quiet batch
        rows = [(k, float(v)) for k, vs in values.items() for v in vs] + [(0, None)]
        frame = spark.createDataFrame(rows, "tenant int, score double")
        judged = sketches.judge(frame, batch, F.lit(7))
        if batch == 0:
            assert {r["cutoff"] for r in judged.select("cutoff").distinct().collect()} == {7}
        for r in (sketches.cutoffs(batch).collect() if batch else []):
            held = np.sort(past[r["tenant"]])
            low, high = (np.searchsorted(held, r["cutoff"] + d, side) / len(held) for d, side in ((0, "left"), (1, "right")))
            assert r["n"] == len(held) and low <= q + error and high >= q - error
        for _ in range(2):  # a repeated batch changes nothing
            sketches.update(frame, batch)
        for k, vs in values.items():
            past[k] += list(vs)
    other = spark.createDataFrame([(9, 8.0)], "tenant int, score double")  # a tenant without scores yet
    assert sketches.judge(other, 5, F.lit(7)).first()["is_anomalous"] is True


def test_sketch_sizes():
    assert 8 <= sketch_size(0.5) < sketch_size(0.01) < sketch_size(0.001) <= MOST_K
    for error in (0.0, 1e-7):
        with pytest.raises(ValueError):
            sketch_size(error)


def test_edge_stream_learns_its_cutoff(spark, tmp_path):
    edge = Tables(spark, "/root/testdata/sf0.001").flow().select(F.col("id").alias("seq"), F.col("sa").alias("src"), F.col("da").alias("dst"), F.col("sec").alias("epoch"))
    path = str(tmp_path)
    sketches = CutoffSketches(spark, f"{path}/cut", q=0.9, error=0.01)
    job = B.EdgeStream(spark, f"{path}/state", B.write_each(f"{path}/out"), 7200, cutoffs=sketches, fallback=4, cols=64)
    for batch, (a, b) in enumerate([(0, 400), (400, 700), (700, 1000)]):
        job(edge.filter((F.col("seq") >= a) & (F.col("seq") < b)), batch)
    got = spark.read.parquet(f"{path}/out").toPandas().sort_values("seq")
    want = E.filtered_burst(E.with_slots(edge, "epoch", 7200, "seq"), cols=64).toPandas().sort_values("seq")
    np.testing.assert_allclose(got["score"].to_numpy(), want["score"].to_numpy(), rtol=1e-9, atol=1e-9)
    assert (got["is_anomalous"] == (got["score"] > got["cutoff"])).all()
    for batch in range(3):
        cutoff = got.loc[got["batch"] == batch, "cutoff"].unique().tolist()
        past = np.sort(got.loc[got["batch"] < batch, "score"])
        if batch == 0:
            assert cutoff == [4]
        else:
            assert np.searchsorted(past, cutoff[0]) / len(past) <= 0.91 and np.searchsorted(past, cutoff[0] + 1, "right") / len(past) >= 0.89
