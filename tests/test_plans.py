import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from flowguard.plans import edge_scores
from flowguard.plans.netflow_forest import NetflowForest
from flowguard.plans.suite.base import Tables
from flowguard.sources.parse import parse_flow, parse_results
from flowguard.streaming import batches as B

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def flows(spark):
    return parse_flow(Tables(spark, DATA).messages(48), 48, keep=["id", "value"]).cache()


def test_forest_verdicts_survive_saving(spark, flows, tmp_path):
    model = NetflowForest.fit(flows, numTrees=20, seed=3)
    first = model.score(flows).select("id", "anomalyScore").toPandas().sort_values("id")
    model.save(str(tmp_path / "model"))
    again = NetflowForest.load(str(tmp_path / "model")).score(flows).select("id", "anomalyScore").toPandas().sort_values("id")
    assert len(first) == flows.filter("stos in ('0', '1', '2', '3')").count()
    assert abs(first.anomalyScore.to_numpy() - again.anomalyScore.to_numpy()).max() < 1e-12
    results = parse_results(model.messages(flows))
    assert results.count() == len(first) and results.select("module").distinct().first()[0] == "IFOREST"
    done = []
    look = B.LookBack(spark, str(tmp_path / "context"), 600, B_score(model, done))
    rows = flows.withColumn("sec", F.unix_timestamp("ts"))
    look(rows.filter("id < 500"), 0)
    look(rows.filter("id >= 500"), 1)
    assert sum(done) == len(first)


def B_score(model, done):
    return B.score_flows(model, lambda frame, batch: done.append(frame.count()))


def test_edge_messages(spark):
    messages = Tables(spark, DATA).messages(71)
    scored = edge_scores.score_messages(messages, "5m", cutoff=0, mode="exact")
    results = parse_results(scored)
    assert results.count() == messages.count()
    quiet = edge_scores.score_messages(messages, "5m", mode="exact", only_anomalies=True)
    assert quiet.count() <= messages.count()
    assert edge_scores.retrain_cutoff(messages, "5m", mode="exact").first()["cutoff"] >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_rare_words_reach_the_syslog_forest(spark):
    """Two messages of the same second with the same common words: a rare word in one of them changes its features and score."""
    from flowguard.plans.syslog import SyslogForest

    common = "alpha beta gamma delta epsilon zeta eta theta " * 4
    common += " ".join(f"c{k}" for k in range(30))
    lines = [(k, f"Jan  5 08:{k // 60:02}:{k % 60:02} h app: {common}") for k in range(60)]
    lines += [(100, f"Jan  5 08:00:59 h app: {common}"), (101, f"Jan  5 08:00:59 h app: {common} segfault")]
    frame = spark.createDataFrame(lines, "id long, line string")
    scores = {r["id"]: r["anomalyScore"] for r in SyslogForest.fit(frame, numTrees=25, maxSamples=62, seed=2).score(frame).collect()}
    assert len(scores) == 62 and scores[101] < scores[100]


def test_forest_reads_every_flow_once(spark):
    flows = parse_flow(Tables(spark, DATA).messages(48), 48, keep=["id"])
    n, reads = flows.count(), spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        reads.add(1)
        return text

    flows = flows.withColumn("ts", counted("ts"))
    model = NetflowForest.fit(flows, numTrees=5, seed=1)
    assert reads.value == n
    model.score(flows).collect()
    assert reads.value == 2 * n
