"""Files, persistence and whole jobs over the driver tables: written to the shared folder, read back, compared."""

import json
import uuid
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard.functions import scalar as S
from flowguard.ml import dense as D
from flowguard.ml import features as ML
from flowguard.ml import iforest as I
from flowguard.operators import metrics as M
from flowguard.plans.suite.base import VECTORS_SQL, Tables, query
from flowguard.schema import CONN, MODULE_FEATURES, MODULES
from flowguard.session import ensure_checkpoint_dir
from flowguard.sources import readers, writers
from flowguard.sources.message_log import Log, register


def scratch(t: Tables, name: str) -> str:
    ensure_checkpoint_dir(t.spark)
    return f"{t.spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def _event_log(t: Tables, path: str) -> None:
    """All events as messages of three partitions; offsets follow the event id within each."""
    register(t.spark)
    e = t("events").repartitionByRange(F.col("event_id")).sortWithinPartitions("event_id")
    records = e.select(
        F.col("event_id").cast("string").cast("binary").alias("key"), F.col("props").cast("binary").alias("value"), F.lit("flows").alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"), F.col("ts").cast("timestamp").alias("timestamp"),
    )
    writers.write_messages(records, "message_log", path, batch="0")


def _as_rows(records: DataFrame) -> DataFrame:
    return records.select("partition", "offset", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


_LOG = """log AS (SELECT CAST(user_id % 3 AS INTEGER) AS partition, row_number() OVER (PARTITION BY user_id % 3 ORDER BY event_id) - 1 AS "offset",
  CAST(event_id AS VARCHAR) AS key, props AS value, count(*) OVER (PARTITION BY user_id % 3) AS n FROM events)"""


@query("a01_bounded_topic_scan", f"""WITH {_LOG} SELECT partition, "offset", key, value FROM log WHERE partition <> 2 AND "offset" >= n // 4 AND "offset" < n - n // 4""")
def _(t: Tables):
    """Two partitions of a topic between offsets inside them: a quarter from each end."""
    path = scratch(t, "topic")
    _event_log(t, path)
    bounds = Log(path).bounds()
    ends = {side: json.dumps({"flows": {str(p): (n // 4 if side == 0 else n - n // 4) for (_, p), (_, n) in bounds.items()}}) for side in (0, 1)}
    return _as_rows(readers.read_records(t.spark, "message_log", path, startingOffsets=ends[0], endingOffsets=ends[1], assign='{"flows": [0, 1]}'))


@query("a01_pushed_offsets", f"""WITH {_LOG} SELECT partition, "offset", key, value FROM log WHERE partition IN (0, 2) AND "offset" >= 40""")
def _(t: Tables):
    """Filters on partition and offset, which the log answers from its commits."""
    path = scratch(t, "topic")
    _event_log(t, path)
    return _as_rows(readers.since_offset(readers.read_records(t.spark, "message_log", path), 40).filter("partition IN (0, 2)"))


@query("a10_inferred_csv", "SELECT c_custkey, c_nationkey, round(c_acctbal, 2) AS c_acctbal FROM customer")
def _(t: Tables):
    path = scratch(t, "csv")
    t("customer").select("c_custkey", "c_nationkey", "c_acctbal").write.option("header", True).csv(path)
    back = readers.read_inferred_csv(t.spark, path, header=True)
    return back.select(F.col("c_custkey").cast("long").alias("c_custkey"), F.col("c_nationkey").cast("int").alias("c_nationkey"), F.round("c_acctbal", 2).alias("c_acctbal"))


@query("a11_csv_flow_export", """SELECT CAST(event_id AS VARCHAR) AS ts, CAST(user_id AS VARCHAR) AS sa, event_type AS pr FROM events""")
def _(t: Tables):
    path = scratch(t, "flows")
    fields = t("events").select(F.col("event_id").cast("string").alias("ts"), F.col("user_id").cast("string").alias("sa"), F.col("event_type").alias("pr"))
    fields.write.option("header", True).csv(path)
    return readers.read_flow_csv(t.spark, path, ["ts", "sa", "pr"])


@query("a12_connection_log", """SELECT 'C' || CAST(o_orderkey AS VARCHAR) AS uid, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) / 4 END AS duration,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'ShADadFf' END AS history FROM orders""")
def _(t: Tables):
    path = scratch(t, "conn")
    k = F.col("o_orderkey")
    values = {"uid": F.concat(F.lit("C"), k.cast("string")), "duration": F.when(k % 4 != 0, (F.col("o_custkey") / 4).cast("string")), "history": F.when(k % 3 != 0, "ShADadFf")}
    fields = [F.coalesce(values.get(name, F.lit("0")), F.lit("-")) for name in CONN]
    lines = t("orders").select(F.concat_ws("\t", *fields).alias("value"))
    notes = t.spark.createDataFrame([("#separator \\x09",), ("#fields\tts\tuid",), ("#close\t2024",)], "value string")
    lines.union(notes).write.text(path)
    return readers.read_conn_log(t.spark, path).select("uid", "duration", "history")


@query("a16_arrays_to_frame", """SELECT vec_id AS id, CAST(label AS DOUBLE) AS label, CAST(embedding AS DOUBLE[])[1] AS first, CAST(embedding AS DOUBLE[])[-1] AS last,
  len(embedding) AS n FROM embeddings""")
def _(t: Tables):
    """All vectors, arrays of single precision and integer labels, to (features, label) rows in double."""
    frame = readers.vectors_to_frame(t("embeddings").withColumnRenamed("vec_id", "id"), "embedding", "label", keep=["id"])
    x = F.col("features")
    return frame.select("id", "label", x[0].alias("first"), F.element_at(x, -1).alias("last"), F.size(x).cast("bigint").alias("n"))


@query("a22_stage_materialisation", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey")
def _(t: Tables):
    return writers.materialise(t("orders").groupBy("o_custkey").agg(F.count("*").alias("n")), scratch(t, "stage"))


@query("a23_forest_persistence", "SELECT vec_id AS id, true AS same_score FROM embeddings")
def _(t: Tables):
    rows = t.vectors().select("id", F.col("x").alias("features"))
    model = I.IsolationForest(numTrees=10, maxSamples=64, seed=3).fit(rows)
    path = scratch(t, "forest")
    model.write().overwrite().save(path)
    again = I.IsolationForestModel.load(path).score_samples(rows).select("id", F.col("anomalyScore").alias("again"))
    return model.score_samples(rows).join(again, "id").select("id", (F.col("anomalyScore") == F.col("again")).alias("same_score"))


@query("a24_pipeline_persistence", f"WITH {VECTORS_SQL}, m AS (SELECT avg(x[1]) AS a, stddev_samp(x[1]) AS s FROM vectors) SELECT id, round((x[1] - a) / s, 6) AS z FROM vectors, m")
def _(t: Tables):
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array

    rows = t.vectors().select("id", F.col("x")[0].alias("v"))
    path = scratch(t, "pipeline")
    ML.normaliser(["v"]).fit(rows).write().overwrite().save(path)
    return PipelineModel.load(path).transform(rows).select("id", F.round(vector_to_array("features")[0], 6).alias("z"))


@query("c03_slot_length", "SELECT event_id AS id, CASE event_id % 3 WHEN 0 THEN 30 WHEN 1 THEN 300 ELSE 3600 END AS seconds FROM events")
def _(t: Tables):
    lengths = [S.slot_seconds(x) for x in ("30s", "5m", "60m")]
    e = F.col("event_id")
    picked = F.when(e % 3 == 0, lengths[0]).when(e % 3 == 1, lengths[1]).otherwise(lengths[2])
    return t("events").select(e.alias("id"), picked.cast("int").alias("seconds"))


@query("m08_feature_subset", "SELECT CAST(i AS INTEGER) AS tree, true AS within_subset, true AS known_features FROM range(12) r(i), (SELECT count(*) FROM embeddings)")
def _(t: Tables):
    nodes = I.IsolationForest(numTrees=12, maxSamples=128, maxFeatures=0.25, seed=4).fit(t.vectors().select(F.col("x").alias("features"))).nodes
    frame = t.spark.createDataFrame(nodes, I.NODE_SCHEMA).filter("featureIndex >= 0").groupBy(F.col("treeID").alias("tree"))
    return frame.agg((F.count_distinct("featureIndex") <= 16).alias("within_subset"), F.max("featureIndex").between(0, 63).alias("known_features"))


@query("m13_training_summary", "SELECT count(*) AS n, true AS scored, true AS flagged_by_threshold, true AS counted, true AS threshold_is_a_quantile FROM embeddings")
def _(t: Tables):
    """Training scores, flags and their number, and the threshold: the score at the rank that contamination leaves."""
    model = I.IsolationForest(numTrees=10, maxSamples=64, seed=3).fit(t.vectors().select(F.col("x").alias("features")))
    summary, cut = model.summary, model.getThreshold()
    score = F.col("anomalyScore")
    rank = F.greatest(F.ceil(F.count("*") * 0.9), F.lit(1))
    return summary.predictions.agg(
        F.count("*").alias("n"), F.min(score.between(0, 1)).alias("scored"), F.min((F.col("prediction") == 1) == (score > cut)).alias("flagged_by_threshold"),
        (F.sum("prediction") == summary.numAnomalies).alias("counted"), ((F.count_if(score < cut) < rank) & (F.count_if(score <= cut) >= rank)).alias("threshold_is_a_quantile"))


def _line_sql(what: str) -> str:
    return f"""WITH {VECTORS_SQL}, d AS (SELECT x[1] AS a, x[2] AS y FROM vectors) SELECT {what} FROM d"""


@query("m19_estimator_wrapper", _line_sql("count(*) AS n, true AS loss_falls"))
def _(t: Tables):
    rows = t.vectors().select(F.array(F.col("x")[0]).alias("features"), F.col("x")[1].alias("label"))
    model = D.DenseNetEstimator(layers=[[4, "tanh"], [1]], epochs=4, validationSplit=0.0, learningRate=0.01, numWorkers=2).fit(rows)
    losses = [h["loss"] for h in model.history]
    return model.transform(rows).agg(F.count("prediction").alias("n")).withColumn("loss_falls", F.lit(losses[-1] < losses[0]))


@query("m25_mini_batches", _line_sql("count(*) AS rows_seen, 3 AS rounds"))
def _(t: Tables):
    """Rows that mini-batches of several passes have seen, per pass, are all rows."""
    net = D.Net(1, [D.Layer(1)]).initialise(1)
    history = D.fit_net(t.vectors(), net, F.array(F.col("x")[0]), F.array(F.col("x")[1]), epochs=3, passes=2, workers=4, batch=7)
    seen = [sum(p["n"] for p in h["partitions"]) // 2 for h in history]
    return t.spark.createDataFrame([(seen[0] if len(set(seen)) == 1 else -1, len(seen))], "rows_seen long, rounds int")


@query("t13_per_tenant_output", "SELECT event_id, CAST(user_id % 4 AS VARCHAR) AS tenant_id FROM events")
def _(t: Tables):
    path = scratch(t, "tenants")
    writers.write_by_tenant(t("events").select("event_id", (F.col("user_id") % 4).cast("string").alias("tenant_id")), path)
    # Each tenant's folder is read on its own.
    own = [t.spark.read.parquet(f"{path}/tenant_id={k}").select("event_id", F.lit(str(k)).alias("tenant_id")) for k in range(4)]
    return reduce(DataFrame.unionAll, own)


@query("u05_dynamic_sql_view", "SELECT vec_id AS key, CAST(label AS DOUBLE) AS target FROM embeddings WHERE label > 3")
def _(t: Tables):
    return readers.renamed_by_sql(t.vectors(), {"id": "key", "label": "target"}, "CAST({label} AS DOUBLE)", "{label} > 3")


_P = "CAST(user_id % 5 AS VARCHAR)"
_FLOW = "strftime(ts, '%Y-%m-%d') || ' 00:00:00,' || strftime(ts, '%Y-%m-%d') || ' 00:00:00,7,10.0.0.' || CAST(user_id % 250 AS VARCHAR) || ',10.1.0.1,1,2,TCP,...A.,0,1,2,3'"
_MODULE = "CASE event_type WHEN 'click' THEN 'MIDAS' WHEN 'error' THEN 'IFOREST' WHEN 'purchase' THEN 'AE' WHEN 'signup' THEN 'GANomaly' ELSE 'ZEEKFLOW' END"
_PARTS = " || ',' || ".join(
    f"coalesce(max(CAST(CAST(score AS DOUBLE) AS VARCHAR)) FILTER (WHERE module = '{m}'), 'None') || ',' || coalesce(max(flag) FILTER (WHERE module = '{m}'), 'None')" for m in MODULES)
_LIST = ",".join(["1"] * 33)


@query("p05_aggregator", f"""WITH m AS (SELECT event_id AS id, {_FLOW} AS flow, {_MODULE} AS module, CAST(floor(value) AS BIGINT) + 0.5 AS score,
    CASE WHEN value > 100 THEN '1' ELSE '0' END AS flag FROM events WHERE event_id % 13 <> 0),
  firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY flow, module ORDER BY id) AS r FROM m) WHERE r = 1),
  f AS (SELECT flow, min(id) AS pos, bool_or(flag = '1') AS send, {_PARTS} AS verdicts, bool_or(module IN ('AE', 'IFOREST')) AS featured FROM firsts GROUP BY flow)
  SELECT 'AD-aggr-message-' || CAST(row_number() OVER (ORDER BY pos) - 1 AS VARCHAR) AS key,
    regexp_replace(flow, ',0,1,2,3$', ',1,2,3') || ',' || verdicts || CASE WHEN featured THEN ',{_LIST}' ELSE '' END AS value FROM f WHERE send""")
def _(t: Tables):
    """Result messages of five detectors to fused messages; every 13th message is broken and rejected."""
    from flowguard.plans.aggregator import aggregate

    return aggregate(_result_messages(t))


@query("p05_aggregator_rejects", "SELECT event_id AS id, CASE WHEN event_id % 2 = 0 THEN 'no detector' ELSE 'bad payload' END AS reason FROM events WHERE event_id % 13 = 0")
def _(t: Tables):
    from flowguard.plans.aggregator import rejects

    return rejects(_result_messages(t)).select("id", "reason")


def _result_messages(t: Tables):
    e, day = F.col("event_id"), F.date_format("ts", "yyyy-MM-dd 00:00:00")
    flow = F.concat_ws(",", day, day, F.lit("7"), F.concat(F.lit("10.0.0."), (F.col("user_id") % 250).cast("string")), F.lit("10.1.0.1,1,2,TCP,...A.,0,1,2,3"), F.lit(",".join(["0"] * 35)))

    def message(module: str, name: Column) -> Column:
        listed = F.array(*[F.lit("1")] * 33) if MODULE_FEATURES[module] else None
        return writers.result_csv(flow, module, listed, F.floor("value") + 0.5, F.col("value") > 100)

    kinds = ["click", "purchase", "signup", "error"]
    by_type = dict(zip(["MIDAS", "AE", "GANomaly", "IFOREST"], kinds))
    value = message("ZEEKFLOW", F.col("event_type"))
    for module, kind in by_type.items():
        value = F.when(F.col("event_type") == kind, message(module, F.col("event_type"))).otherwise(value)
    broken = F.when(e % 2 == 0, F.lit("not a message")).otherwise(F.concat(flow, F.lit(',MIDAS,"[1]",x,1')))
    return t("events").select(e.alias("id"), F.when(e % 13 == 0, broken).otherwise(value).alias("value"))


@query("p04_autoencoder_messages", """SELECT event_id AS id, true AS is_result, true AS error_is_mean_square FROM events WHERE event_id % 5 <> 4""")
def _(t: Tables):
    """Flow autoencoder with fixed weights that gives back nothing: its error is the mean square of the 33 features."""
    from flowguard.plans.netflow_autoencoder import NetflowAutoencoder
    from flowguard.sources.parse import parse_flow, parse_results
    from flowguard.session import checkpointed

    flows = checkpointed(parse_flow(t.messages(48), 48, keep=["id"]).join(t.messages(48).select("id", "value"), "id"))
    model = NetflowAutoencoder.fit(flows, hidden=(4,), epochs=1, workers=2)
    model.net = D.Net(33, [D.Layer(33)], [np.zeros((33, 33)), np.zeros(33)])
    back = parse_results(model.messages(flows), keep=["id"])
    x = F.transform(F.split("features", ","), lambda v: v.cast("double"))
    square = F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v) / 33
    return back.select("id", (F.col("module") == "AE").alias("is_result"), (F.abs(square - F.col("score")) < 1e-3 * (1 + square)).alias("error_is_mean_square"))
