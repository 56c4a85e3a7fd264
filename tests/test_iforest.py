import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from flowguard.ml import iforest as I
from flowguard.ml.iforest import IsolationForest, IsolationForestModel
from flowguard.ml.sampling import Sampler, placed


def ramp(spark, rows, dim=2):
    return spark.createDataFrame([(Vectors.dense([float(i)] * dim),) for i in range(1, rows + 1)], ["features"])


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(0)
    inner = rng.normal(0, 1, (950, 4))
    outer = rng.normal(0, 1, (50, 4)) + rng.choice([-6, 6], (50, 4))
    rows = [(Vectors.dense(x), 0.0) for x in inner] + [(Vectors.dense(x), 1.0) for x in outer]
    return spark.createDataFrame(rows, ["features", "label"]).repartition(6).cache()


def auc(df, score="anomalyScore"):
    from flowguard.operators.metrics import roc_auc

    return roc_auc(df, score, "label").first()["auc"]


def test_defaults_and_setters():
    forest = IsolationForest()
    assert forest.getNumTrees() == 100 and forest.getMaxSamples() == 1.0 and forest.getMaxFeatures() == 1.0
    assert forest.getMaxDepth() == 10 and forest.getContamination() == 0.1 and not forest.getBootstrap()
    assert forest.getFeaturesCol() == "features" and forest.getAnomalyScoreCol() == "anomalyScore"
    forest.setNumTrees(10).setMaxSamples(5).setPredictionCol("p").setSeed(9)
    assert (forest.getNumTrees(), forest.getMaxSamples(), forest.getPredictionCol(), forest.getSeed()) == (10, 5.0, "p", 9)
    assert forest.copy().getNumTrees() == 10


@pytest.mark.parametrize("bad", [{"maxSamples": -1}, {"maxFeatures": -1}, {"maxDepth": -1}, {"contamination": -1}, {"numTrees": 0}])
def test_bad_params(bad):
    with pytest.raises(ValueError):
        IsolationForest(**bad)


def test_sample_larger_than_data(spark):
    with pytest.raises(ValueError):
        IsolationForest(maxSamples=20).fit(ramp(spark, 10))


def sources(spark):
    """The same thousand rows, behind shuffles whose partitions Spark merges at run time."""
    base = spark.range(1000).withColumn("k", F.col("id") % 10)
    yield base.repartition(7)
    yield base.repartition("id")
    yield base.join(spark.range(10).withColumnRenamed("id", "k").hint("merge"), "k")
    yield base.groupBy("id").agg(F.max("k").alias("k"))


@pytest.mark.parametrize("partitions", ["3", "8", "200"])
@pytest.mark.parametrize("bootstrap", [False, True])
def test_sample_sizes(spark, bootstrap, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        for source in sources(spark):
            data, starts = placed(source.select(F.array(F.col("id").cast("double")).alias("x")))
            rows = I.sampled_rows(data, Sampler(starts, 64, bootstrap, 3), 5)
            got = rows.groupBy("tree").agg(F.sum("copies").alias("n"), F.count_distinct("x").alias("d")).collect()
            assert len(got) == 5 and all(r["n"] == 64 for r in got)
            assert all(r["d"] == 64 if not bootstrap else 50 < r["d"] < 64 for r in got)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("bootstrap", [False, True])
def test_listed_and_asked_samples_agree(bootstrap):
    for total, size in ((1, 1), (7, 3), (300_000, 256), (300_000, 200_000), (1000, 1000)):
        sampler = Sampler(np.array([0, total]), size, bootstrap, 11)
        rows, tree, copies = sampler.draws(3)
        for t in range(3):
            mine = tree == t
            want = np.zeros(total, int)
            want[rows[mine]] = copies[mine]
            assert want.sum() == size and (sampler.copies(t, np.arange(total)) == want).all()


def test_samples_are_uniform():
    hits = np.zeros(100)
    sampler = Sampler(np.array([0, 100]), 10, False, 5)
    for t in range(3000):
        hits[sampler._shuffle(t, np.arange(10), True)] += 1
    assert abs(hits - 300).max() < 90  # five standard deviations


def test_large_samples_are_exact_too(spark, monkeypatch):
    data = spark.range(3000).repartition("id").select(F.array(F.col("id").cast("double"), (F.col("id") % 7).cast("double")).alias("features"))
    monkeypatch.setattr(I, "IN_TASK_SAMPLE", 100)
    for bootstrap in (False, True):
        model = IsolationForest(numTrees=4, maxSamples=1000, bootstrap=bootstrap, maxDepth=5).fit(data)
        assert (model.nodes.groupby("treeID")["numInstance"].sum() == 1000).all()


def test_null_and_ragged_vectors(spark):
    rows = [(i, [float(i), 1.0, 2.0]) for i in range(60)] + [(60, None), (61, None)]
    data = spark.createDataFrame(rows, "id int, features array<double>").coalesce(1)
    model = IsolationForest(numTrees=5, maxSamples=30).fit(data)
    got = {r["id"]: r["anomalyScore"] for r in model.score_samples(data).collect()}
    assert got[60] is None and got[61] is None and all(0 < got[i] < 1 for i in range(60))
    want = {r["id"]: r["anomalyScore"] for r in model.score_samples(data.filter("id < 60")).collect()}
    assert all(got[i] == want[i] for i in range(60))
    assert [r["anomalyScore"] for r in model.score_samples(data.filter("id >= 60")).collect()] == [None, None]
    with pytest.raises(Exception, match="different lengths"):
        model.score_samples(spark.createDataFrame([([1.0],), ([1.0, 2.0],)], "features array<double>").coalesce(1)).collect()


def test_matrix_keeps_rows_apart():
    import pyarrow as pa

    x = I.matrix(pa.array([[1.0, 2.0], None, [3.0, None]]))
    assert x.shape == (3, 2) and x[0].tolist() == [1, 2] and np.isnan(x[1]).all() and x[2][0] == 3
    assert I.matrix(pa.array([None, None], pa.list_(pa.float64()))).shape == (2, 0)
    assert I.matrix(pa.array([[1.0], [2.0], [3.0]])[1:]).tolist() == [[2.0], [3.0]]


def test_sampling_everything_keeps_every_row(spark):
    data, starts = placed(spark.range(50).select(F.array(F.col("id").cast("double")).alias("x")))
    rows = I.sampled_rows(data, Sampler(starts, 50, False, 3), 2).toPandas()
    for _, part in rows.groupby("tree"):
        assert sorted(v[0] for v in part["x"]) == [float(i) for i in range(50)]


def test_feature_subset():
    assert (I.subset_size(1.0, 3), I.subset_size(0.7, 3), I.subset_size(2, 3), I.subset_size(9, 3)) == (3, 2, 2, 3)
    x = np.random.default_rng(1).normal(size=(200, 6))
    nodes = I.build_tree(x, np.ones(200, dtype=int), 8, 2, 2, 0)
    assert len({n[1] for n in nodes if n[1] >= 0}) <= 2


def test_tree_invariants():
    x = np.random.default_rng(1).normal(size=(200, 3))
    nodes = I.build_tree(x, np.ones(200, dtype=int), 6, 1.0, 2, 0)
    assert [n[0] for n in nodes] == list(range(len(nodes)))
    assert sum(n[5] for n in nodes) == 200
    assert I.build_tree(np.ones((9, 2)), np.ones(9, dtype=int), 6, 1.0, 2, 0) == [(0, -1, -1.0, -1, -1, 9)]


def test_two_outliers_of_ten(spark):
    model = IsolationForest(contamination=0.2, maxSamples=10, numTrees=50).fit(ramp(spark, 10))
    assert model.hasSummary and model.summary.numAnomalies <= 2
    assert model.summary.predictions.count() == 10


def test_far_point_is_flagged(spark):
    points = [(Vectors.dense(v),) for v in ([0.0, 0.0], [7.0, 9.0], [9.0, 8.0], [8.0, 9.0])]
    df = spark.createDataFrame(points, ["features"])
    model = IsolationForest(contamination=0.3, maxDepth=2, numTrees=200).fit(df)
    rows = model.transform(df).collect()
    flagged = [r["features"].toArray().tolist() for r in rows if r["prediction"] == 1.0]
    assert model.summary.numAnomalies == 1 and flagged == [[0.0, 0.0]]


def test_quality_and_seed(cloud):
    fit = lambda: IsolationForest(maxSamples=128, seed=5).fit(cloud)
    model = fit()
    scored = model.transform(cloud)
    assert auc(scored) > 0.97
    assert scored.filter("anomalyScore <= 0 or anomalyScore >= 1").count() == 0
    assert model.nodes.equals(fit().nodes)


def test_levelwise_matches_in_quality(cloud, monkeypatch):
    monkeypatch.setattr(I, "IN_TASK_SAMPLE", 10)
    for bootstrap in (False, True):
        model = IsolationForest(maxSamples=1.0, numTrees=30, maxDepth=7, bootstrap=bootstrap).fit(cloud)
        per_tree = model.nodes.groupby("treeID")["numInstance"].sum()
        assert auc(model.transform(cloud)) > 0.95
        if not bootstrap:
            assert (per_tree == 1000).all()


def test_save_load_and_pipeline(cloud, tmp_path):
    model = IsolationForest(maxSamples=64, numTrees=20).fit(cloud)
    model.write().overwrite().save(str(tmp_path / "m"))
    back = IsolationForestModel.load(str(tmp_path / "m"))
    assert back.nodes.equals(model.nodes) and back.getThreshold() == model.getThreshold()
    a = model.transform(cloud).select(F.sum("anomalyScore"), F.sum("prediction")).first()
    b = back.transform(cloud).select(F.sum("anomalyScore"), F.sum("prediction")).first()
    assert a[0] == pytest.approx(b[0]) and a[1] == b[1]
    chain = Pipeline(stages=[IsolationForest(maxSamples=64, numTrees=20)]).fit(cloud)
    chain.write().overwrite().save(str(tmp_path / "p"))
    assert PipelineModel.load(str(tmp_path / "p")).transform(cloud).count() == 1000


def test_scores_equal_a_plain_walk(cloud):
    model = IsolationForest(maxSamples=64, numTrees=5).fit(cloud)
    rows = model.transform(cloud).limit(20).collect()
    trees = [t.set_index("id").to_dict("index") for _, t in model.nodes.groupby("treeID")]
    for r in rows:
        total = 0.0
        for tree in trees:
            node, depth = tree[0], 0
            while node["featureIndex"] >= 0:
                left = r["features"][node["featureIndex"]] < node["featureValue"]
                node, depth = tree[node["leftChild" if left else "rightChild"]], depth + 1
            total += depth + float(I.path_correction(node["numInstance"]))
        want = 2 ** (-total / 5 / float(I.path_correction(64)))
        assert r["anomalyScore"] == pytest.approx(want)


@pytest.mark.parametrize("bootstrap", [False, True])
@pytest.mark.parametrize("features", [1.0, 0.5])
def test_both_builders_grow_the_same_trees(cloud, monkeypatch, bootstrap, features):
    forest = IsolationForest(numTrees=6, maxSamples=300, maxFeatures=features, maxDepth=7, bootstrap=bootstrap, seed=5)
    inside = forest.fit(cloud).nodes.sort_values(["treeID", "id"], ignore_index=True)
    monkeypatch.setattr(I, "IN_TASK_SAMPLE", 10)
    levels = forest.fit(cloud).nodes.sort_values(["treeID", "id"], ignore_index=True)
    for c in inside.columns:
        np.testing.assert_array_equal(inside[c].to_numpy(), levels[c].to_numpy())
    assert inside["id"].max() > 30
