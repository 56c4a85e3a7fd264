"""Models fitted and applied over whole tables, next to the closed forms in ``models.py``."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowguard.ml import text as X
from flowguard.plans.suite.base import Tables, query
from flowguard.plans.suite.models import _WORDS
from flowguard.session import checkpointed


def _beyond(n: int) -> str:
    """Expected path below a leaf of n rows."""
    return "0.0" if n < 2 else "1.0" if n == 2 else f"(2 * (ln({n - 1}) + 0.5772156649) - 2 * {n - 1} / {n}.0)"


# Two trees over term weights (kind 0) and rolling windows (mean of 60 s: 1, deviation of 600 s: 4), written by hand:
# (tree, id, term, kind, cut, left, right, rows).
_SPARSE_NODES = [
    (0, 0, "the", 0, 0.2, 1, 4, 0), (0, 1, "in", 1, 0.05, 2, 3, 0), (0, 2, None, -1, -1.0, -1, -1, 3), (0, 3, None, -1, -1.0, -1, -1, 5), (0, 4, None, -1, -1.0, -1, -1, 2),
    (1, 0, "of", 4, 0.09, 1, 2, 0), (1, 1, None, -1, -1.0, -1, -1, 4), (1, 2, "en", 0, 0.05, 3, 4, 0), (1, 3, None, -1, -1.0, -1, -1, 6), (1, 4, None, -1, -1.0, -1, -1, 1),
]


@query("m27_sparse_forest", f"""WITH w AS (SELECT doc_id, {_WORDS} AS term FROM documents),
  df AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) * 1.0::DOUBLE / (1 + count(DISTINCT doc_id))) + 1 AS idf FROM w GROUP BY term),
  tf AS (SELECT doc_id, term, count(*) * any_value(idf) AS weight FROM w JOIN df USING (term) GROUP BY doc_id, term),
  unit AS (SELECT doc_id, (doc_id // 3) * 7 AS sec, term, weight / sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)) AS weight FROM tf),
  docs AS (SELECT doc_id, (doc_id // 3) * 7 AS sec FROM documents),
  seconds AS (SELECT sec, count(*) AS n FROM docs GROUP BY sec),
  cells AS (SELECT term, sec, sum(weight) AS s, sum(weight * weight) AS q FROM unit WHERE term IN ('in', 'of') GROUP BY ALL),
  near AS (SELECT a.sec, (SELECT sum(n) FROM seconds b WHERE b.sec BETWEEN a.sec - 59 AND a.sec) AS n_60, (SELECT sum(n) FROM seconds b WHERE b.sec BETWEEN a.sec - 599 AND a.sec) AS n_600,
    coalesce((SELECT sum(s) FROM cells c WHERE c.term = 'in' AND c.sec BETWEEN a.sec - 59 AND a.sec), 0) AS s_60,
    coalesce((SELECT sum(s) FROM cells c WHERE c.term = 'of' AND c.sec BETWEEN a.sec - 599 AND a.sec), 0) AS s_600,
    coalesce((SELECT sum(q) FROM cells c WHERE c.term = 'of' AND c.sec BETWEEN a.sec - 599 AND a.sec), 0) AS q_600 FROM seconds a),
  x AS (SELECT d.doc_id, coalesce(t.weight, 0) AS the, coalesce(e.weight, 0) AS en, s_60 / n_60 AS mean_in,
    CASE WHEN n_600 > 1 THEN sqrt(greatest(q_600 - s_600 * s_600 / n_600, 0) / (n_600 - 1)) ELSE 0 END AS std_of
    FROM docs d JOIN near USING (sec) LEFT JOIN unit t ON t.doc_id = d.doc_id AND t.term = 'the' LEFT JOIN unit e ON e.doc_id = d.doc_id AND e.term = 'en')
  SELECT doc_id AS id, round(pow(2, -(CASE WHEN the >= 0.2 THEN 1 + {_beyond(2)} WHEN mean_in < 0.05 THEN 2 + {_beyond(3)} ELSE 2 + {_beyond(5)} END
    + CASE WHEN std_of < 0.09 THEN 1 + {_beyond(4)} WHEN en < 0.05 THEN 2 + {_beyond(6)} ELSE 2 + {_beyond(1)} END) / 2 / {_beyond(11)}), 9) AS score FROM x""")
def _(t: Tables):
    """Hand-made trees over terms and windows of all documents: weights, windows and walks of the sparse forest."""
    import pandas as pd

    from flowguard.ml.sparse_forest import SparseForest

    docs = t("documents").select(F.col("doc_id").alias("id"), "text", (F.floor(F.col("doc_id") / 3) * 7).cast("bigint").alias("sec"))
    counts = checkpointed(X.term_counts(docs, "text"))
    weights = X.tfidf(docs, X.fit_vocabulary(docs, "text", counts=counts), "text", counts=counts).select("id", "term", "weight")
    columns = ["treeID", "id", "term", "kind", "featureValue", "leftChild", "rightChild", "numInstance"]
    forest = SparseForest(pd.DataFrame(_SPARSE_NODES, columns=columns), 11, (60, 600))
    return forest.score(weights, docs.select("id", "sec")).select("id", F.round("score", 9).alias("score"))


def _joint_net():
    """Two inputs (three and two numbers), a branch each, one shared code, two outputs; weights written by hand."""
    import numpy as np

    from flowguard.ml import dense as D

    net = D.GraphNet([("flow", 3), ("history", 2)], [
        D.Node("f", ("flow",), 2, "relu"), D.Node("h", ("history",), 1, "leaky_relu"), D.Node("code", ("f", "h"), 2, "tanh"),
        D.Node("flow_back", ("code",), 3), D.Node("history_back", ("code",), 2, "sigmoid")], [("flow_back", 1.0), ("history_back", 1.0)])
    net.weights = [np.array(w, float) for w in (
        [[0.5, -1.0], [2.0, 0.25], [-0.75, 1.5]], [0.125, -0.0625], [[3.0], [-1.5]], [0.03125], [[1.0, -0.5], [0.25, 2.0], [-1.25, 0.75]], [0.0, 0.5],
        [[0.5, 1.0, -1.0], [0.75, -0.25, 0.5]], [0.0, 0.125, -0.25], [[1.5, -2.0], [0.5, 1.0]], [-0.5, 0.25])]
    return net


def _joint_sql() -> str:
    """The same network written out as SQL expressions, node after node."""
    net = _joint_net()
    shape = {"linear": "({})", "relu": "greatest({}, 0)", "leaky_relu": "(CASE WHEN {0} > 0 THEN {0} ELSE 0.3 * ({0}) END)", "tanh": "tanh({})", "sigmoid": "(1 / (1 + exp(-({}))))"}
    known = {"flow": [f"x[{i}]" for i in (1, 2, 3)], "history": ["x[4]", "x[5]"]}
    steps, source = ["SELECT id, x FROM vectors"], "s0"
    for i, node in enumerate(net.nodes):
        cells = [c for s in node.sources for c in known[s]]
        known[node.name] = [f"{node.name}_{j}" for j in range(node.units)]
        sums = [" + ".join([f"{float(b)!r}::DOUBLE", *[f"{float(w)!r}::DOUBLE * {c}" for w, c in zip(column, cells)]]) for column, b in zip(net.weights[2 * i].T, net.weights[2 * i + 1])]
        steps.append(f"SELECT *, {', '.join(f'{shape[node.activation].format(v)} AS {name}' for v, name in zip(sums, known[node.name]))} FROM s{i}")
        source = f"s{i + 1}"
    views = [" + ".join(f"abs({a} - {b})" for a, b in zip(known[f"{v}_back"], known[v])) for v in ("flow", "history")]
    ctes = ", ".join(f"s{i} AS ({s})" for i, s in enumerate(steps))
    return f"""WITH vectors AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings), {ctes},
      e AS (SELECT id, {views[0]} AS flow_error, {views[1]} AS history_error FROM {source})
      SELECT id, round(flow_error, 8) AS flow_error, round(history_error, 8) AS history_error,
        round(history_error + flow_error * (SELECT avg(history_error) / avg(flow_error) FROM e), 7) AS combined_error FROM e"""


@query("m23_joint_errors", _joint_sql())
def _(t: Tables):
    """Flow, history and combined errors of one network with two inputs and two outputs."""
    from flowguard.ml import dense as D

    rows = t.vectors().select("id", F.slice("x", 1, 3).alias("flow"), F.slice("x", 4, 2).alias("history"))
    scored = D.score_joint(rows, _joint_net())
    return scored.select("id", *[F.round(c, d).alias(c) for c, d in (("flow_error", 8), ("history_error", 8), ("combined_error", 7))])


_LEVELS = "SELECT CAST(i AS INTEGER) AS tree, least({size}, n) AS sampled_rows, true AS binary_tree, true AS grew FROM range({trees}) r(i), (SELECT count(*) AS n FROM embeddings)"


@query("m14_levelwise_growth", _LEVELS.format(size="n", trees=8))
def _(t: Tables):
    """All trees level by level over every row, eight levels deep."""
    from flowguard.ml import iforest as I
    from flowguard.ml.sampling import Sampler, placed

    data, starts = placed(t.vectors().select("x"))
    nodes = I._fit_levels(data, Sampler(starts, int(starts[-1]), False, 2), trees=8, depth=8, features=0.5)
    leaf = F.col("featureIndex") < 0
    return nodes.groupBy(F.col("treeID").alias("tree")).agg(
        F.sum("numInstance").alias("sampled_rows"), (F.count_if(leaf) == F.count_if(~leaf) + 1).alias("binary_tree"), (F.count_if(leaf) > 8).alias("grew"))


def _fitted(t: Tables):
    from flowguard.ml import iforest as I

    rows = t.vectors().select("id", F.col("x").alias("features"))
    return I.IsolationForest(numTrees=25, maxSamples=128, seed=3).fit(rows), rows


@query("m11_fitted_scores", "SELECT vec_id AS id, true AS as_walked FROM embeddings")
def _(t: Tables):
    """Scores of a fitted forest, each against a walk by joins: every tree's node per row, level after level."""
    from flowguard.ml import iforest as I

    model, rows = _fitted(t)
    nodes = t.spark.createDataFrame(model.nodes, I.NODE_SCHEMA)
    below = F.when(F.col("numInstance") > 2, 2 * (F.log(F.col("numInstance") - 1) + I.EULER) - 2 * (F.col("numInstance") - 1) / F.col("numInstance")).otherwise((F.col("numInstance") == 2).cast("double"))
    tree = nodes.withColumn("below", below).withColumnRenamed("id", "node")
    roots = F.array(*[F.lit(k) for k in range(model.trees)])
    at = rows.select("id", "features", F.explode(roots).alias("treeID"), F.lit(0).alias("node"), F.lit(0).alias("depth"))
    for _ in range(8):
        step = at.join(F.broadcast(tree), ["treeID", "node"])
        child = F.when(F.col("featureIndex") < 0, F.col("node")).when(F.get("features", F.col("featureIndex")) < F.col("featureValue"), F.col("leftChild")).otherwise(F.col("rightChild"))
        at = step.select("id", "features", "treeID", child.alias("node"), (F.col("depth") + (F.col("featureIndex") >= 0).cast("int")).alias("depth"))
    paths = at.join(F.broadcast(tree), ["treeID", "node"]).groupBy("id").agg(F.avg(F.col("depth") + F.col("below")).alias("path"))
    walked = paths.select("id", F.pow(F.lit(2.0), -F.col("path") / float(I.path_correction(128))).alias("walked"))
    scored = model.score_samples(rows).select("id", "anomalyScore")
    return scored.join(walked, "id").select("id", (F.abs(F.col("anomalyScore") - F.col("walked")) < 1e-9).alias("as_walked"))


@query("m12_fitted_predictions", "SELECT true AS by_threshold, count(*) AS n, true AS within_contamination FROM embeddings")
def _(t: Tables):
    """Predictions of a fitted forest at the threshold that its contamination sets; e24's count is within that share."""
    model, rows = _fitted(t)
    out, cut = model.transform(rows), model.getThreshold()
    agg = out.agg(F.min((F.col("prediction") == 1) == (F.col("anomalyScore") > cut)).alias("by_threshold"), F.count("*").alias("n"), F.sum("prediction").alias("p"))
    return agg.select("by_threshold", "n", ((F.col("p") > 0) & (F.col("p") <= 0.1 * F.col("n"))).alias("within_contamination"))


@query("m18_dense_epochs", "SELECT CAST(i AS INTEGER) AS epoch, n, true AS improves FROM range(3) r(i), (SELECT count(*) AS n FROM embeddings)")
def _(t: Tables):
    """Three epochs of a classifier with a hidden layer over all rows."""
    from flowguard.functions.scalar import one_hot
    from flowguard.ml import dense as D

    net = D.Net(64, [D.Layer(32, "relu"), D.Layer(10, "softmax")]).initialise(1)
    y = one_hot(F.pmod(F.col("label"), F.lit(10)), 10)
    notes = D.fit_net(t.vectors(), net, F.col("x"), y, "categorical_crossentropy", epochs=3, workers=4, rate=0.01)
    rows = [(n["epoch"], sum(p["n"] for p in n["partitions"]), k == 0 or n["loss"] < notes[k - 1]["loss"]) for k, n in enumerate(notes)]
    return t.spark.createDataFrame(rows, "epoch int, n long, improves boolean")


@query("m22_trained_autoencoder", "SELECT vec_id AS id, true AS flag_by_score, true AS better_than_nothing FROM embeddings")
def _(t: Tables):
    """A trained autoencoder's error per row; on average below that of giving back nothing."""
    from flowguard.ml import dense as D

    rows = t.vectors().select("id", F.col("x").alias("features"))
    net, _ = D.fit_autoencoder(rows, "features", hidden=(32,), epochs=4, rate=0.01, workers=2)
    scored = D.score_autoencoder(rows, net, "features", cutoff=0.012)
    square = F.aggregate("features", F.lit(0.0), lambda a, v: a + v * v) / 64
    better = scored.agg((F.avg("score") < F.avg(square)).alias("better_than_nothing"))
    return scored.select("id", (F.col("is_anomalous") == (F.col("score") > 0.012)).alias("flag_by_score")).join(F.broadcast(better))


@query("m15_m16_family_votes", "SELECT vec_id AS id, true AS votes_agree, true AS named FROM embeddings")
def _(t: Tables):
    """Fitted family forest: the predicted class has the most probability, and its text is restored."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    from flowguard.ml import features as ML

    rows = t.vectors().select("id", array_to_vector("x").alias("features"), F.pmod("label", F.lit(10)).cast("double").alias("label"))
    out = ML.family_classifier([f"family{i}" for i in range(10)], trees=20, rate=0.5).fit(rows).transform(rows)
    p = vector_to_array("probability")
    at = F.col("prediction").cast("int")
    return out.select("id", (F.get(p, at) == F.array_max(p)).alias("votes_agree"), (F.col("family") == F.concat(F.lit("family"), at.cast("string"))).alias("named"))
