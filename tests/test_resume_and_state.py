"""Training that goes on after a lost driver, the nearest of many categories, rings of last rows."""

import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowguard.ml import dense as D
from flowguard.operators import clean
from flowguard.plans.suite.streams import _feed
from flowguard.streaming import batches as B
from flowguard.streaming.rings import last_rows_stream


class Lost(RuntimeError):
    pass


def rows(spark):
    return spark.range(300).select(F.array(F.sin("id"), F.cos("id"), F.sin("id") * F.cos("id")).alias("flow"), (F.col("id") % 10 == 0).cast("int").alias("label"))


@pytest.mark.parametrize("optimizer", ["adam", "rmsprop", "sgd"])
def test_resumed_training_ends_with_the_same_weights(spark, tmp_path, optimizer):
    x = F.col("flow")
    options = dict(epochs=4, workers=3, rate=0.01, batch=16, optimizer=optimizer, validation=0.1)
    fresh = lambda: D.Net(3, [D.Layer(5, "tanh"), D.Layer(3)]).initialise(2)
    whole, cut, again = fresh(), fresh(), fresh()
    notes = D.fit_net(rows(spark), whole, x, x, resume=str(tmp_path / "whole"), **options)

    def die(epoch, net):
        if epoch == 2:
            raise Lost

    with pytest.raises(Lost):
        D.fit_net(rows(spark), cut, x, x, resume=str(tmp_path / "cut"), after_round=die, **options)
    # Other rows are given now: the first run's are on record. Epoch 2 was not noted and is trained again.
    resumed = D.fit_net(rows(spark).limit(0), again, x, x, resume=str(tmp_path / "cut"), **options)
    for a, b in zip(whole.weights, again.weights):
        np.testing.assert_allclose(a, b, rtol=1e-9, atol=1e-12)
    assert [n["epoch"] for n in resumed] == [0, 1, 2, 3] and np.allclose([n["loss"] for n in resumed], [n["loss"] for n in notes])
    done = fresh()
    assert D.fit_net(rows(spark), done, x, x, resume=str(tmp_path / "cut"), **options)[-1]["epoch"] == 3  # nothing left to train
    np.testing.assert_array_equal(done.weights[0], again.weights[0])
    with pytest.raises(ValueError, match="another training"):
        D.fit_net(rows(spark), fresh(), x, x, resume=str(tmp_path / "cut"), **(options | {"rate": 0.5}))


def test_moments_go_on_between_rounds(spark):
    """One partition whose batch is all of it: rounds of one step are plain consecutive Adam steps."""
    data = rows(spark).select(F.col("flow").alias("x"), F.col("flow").alias("y")).coalesce(1)
    net, same, moments = D.Net(3, [D.Layer(3)]).initialise(1), D.Net(3, [D.Layer(3)]).initialise(1), D.Moments()
    x = np.array([r["x"] for r in data.collect()])
    steps = D._Optimizer("adam", 0.01)
    for turn in range(3):
        D.train_round(data, net, "mse", 300, "adam", 0.01, turn, True, moments)
        steps.apply(same.weights, same.gradients(x, x, D.LOSSES["mse"], np.random.default_rng(0))[1])
    for a, b in zip(net.weights, same.weights):
        np.testing.assert_allclose(a, b, rtol=1e-8, atol=1e-10)
    assert moments.step == 3


def test_resumed_retraining_keeps_its_best_evaluation(spark, tmp_path, monkeypatch):
    data, options = rows(spark), dict(rounds=4, evaluate_every=1, rate=0.01, workers=2)
    fresh = lambda: D.Net(3, D.autoencoder_layers(3, (4,))).initialise(1)
    want = D.retrain(data, data, fresh(), resume=str(tmp_path / "a"), **options)
    real, calls = D.train_round, []

    def dies(*args, **kw):
        calls.append(1)
        if len(calls) == 3:
            raise Lost
        return real(*args, **kw)

    monkeypatch.setattr(D, "train_round", dies)
    with pytest.raises(Lost):
        D.retrain(data, data, fresh(), resume=str(tmp_path / "b"), **options)
    got = D.retrain(data, data, fresh(), resume=str(tmp_path / "b"), **options)
    assert [e["auc"] for e in got["evaluations"]] == pytest.approx([e["auc"] for e in want["evaluations"]])
    assert got["auc"] == pytest.approx(max(e["auc"] for e in want["evaluations"])) and got["cutoff"] == pytest.approx(want["cutoff"])
    for a, b in zip(got["weights"], want["weights"]):
        np.testing.assert_allclose(a, b, rtol=1e-9, atol=1e-12)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_nearest_of_ten_thousand_categories(spark):
    rng = random.Random(4)
    names = sorted({"".join(rng.choice("abcdé.") for _ in range(rng.randint(3, 9))) for _ in range(13_000)})
    rng.shuffle(names)
    names = names[:10_000]
    known = spark.createDataFrame([(n, i) for i, n in enumerate(names)] + [(names[0], 10**6), (None, 0)], "category string, order long")
    values = [names[5], names[7][1:], names[9] + "zz", "z" * 20, "", "q", "abcdabcdabcd", names[11].upper(), None, names[5]]
    values += ["".join(rng.choice("abcdé.x") for _ in range(rng.randint(0, 9))) for _ in range(60)]
    asked = spark.createDataFrame(list(enumerate(values)), "id int, v string")
    out = clean.nearest_category(asked, "v", known)
    assert len(names) == 10_000 and len(out._jdf.queryExecution().toString()) < 200_000 and names[4321] not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {r["id"]: r["v"] for r in out.collect()}
    for i, v in enumerate(values):
        want = None if v is None else min((edits(v, n), k) for k, n in enumerate(names))[1] if i % 6 == 0 or i < 9 else None
        if v is None:
            assert got[i] is None
        elif want is not None:
            assert got[i] == names[want], v
    assert out.columns == ["id", "v"] and len(got) == len(values)
    none = clean.nearest_category(asked, "v", known.limit(0)).collect()
    assert len(none) == len(values) and all(r["v"] is None for r in none)


def test_rings_hold_the_last_rows_over_batches(spark, tmp_path):
    path, n = str(tmp_path), 7
    parts = [[("a", i, float(i)) for i in range(3)], [("a", i, float(i)) for i in range(3, 30)] + [("b", 5, None)], [("b", i, 1.0) for i in range(6, 10)], [("a", 30, 0.5)]]
    frames = [spark.createDataFrame(p, "key string, id long, v double").repartition(3) for p in parts]
    stream = lambda: last_rows_stream(spark.readStream.schema(frames[0].schema).parquet(f"{path}/in"), n, "key", "id")
    _feed(frames, f"{path}/in", stream, B.write_each(f"{path}/out"), path)
    out = spark.read.parquet(f"{path}/out").collect()
    for batch in range(4):
        upto = [r for p in parts[: batch + 1] for r in p]
        for key in {r[0] for r in parts[batch]}:
            want = sorted((r for r in upto if r[0] == key), key=lambda r: r[1])[-n:]
            assert sorted((r["key"], r["id"], r["v"]) for r in out if r["batch"] == batch and r["key"] == key) == want
    state = spark.read.format("statestore").option("stateVarName", "rows").load(f"{path}/progress")
    assert state.count() == 7 + 5
    with pytest.raises(ValueError):
        last_rows_stream(stream(), 0, "key", "id")


def test_micro_batches_leave_no_tables_behind(spark, tmp_path):
    from flowguard.plans.suite.base import Tables
    from flowguard.session import checkpointed, ensure_checkpoint_dir, temporary_tables

    ensure_checkpoint_dir(spark)
    folder = spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:")
    tables = lambda: {p.name for p in Path(folder).glob("table-*")}
    before, path = tables(), str(tmp_path)
    edge = Tables(spark, "/root/testdata/sf0.001").flow().select(F.col("id").alias("seq"), F.col("sa").alias("src"), F.col("da").alias("dst"), F.col("sec").alias("epoch"))
    job = B.EdgeStream(spark, f"{path}/state", B.write_each(f"{path}/out"), 7200, cols=64)
    _feed([edge.filter("seq < 300"), edge.filter("seq >= 300")], f"{path}/in", lambda: spark.readStream.schema(edge.schema).parquet(f"{path}/in"), job, path)
    assert spark.read.parquet(f"{path}/out").count() == edge.count() and tables() == before
    with temporary_tables(spark) as outer:
        kept = checkpointed(edge.limit(3))
        with temporary_tables(spark):
            checkpointed(edge.limit(2))
        assert kept.count() == 3 and len(outer) == 1 and len(tables()) == len(before) + 1
    assert tables() == before
