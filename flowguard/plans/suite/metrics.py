"""Queries over quality measures."""

from pyspark.sql import functions as F

from flowguard.operators import metrics as M
from flowguard.plans.suite.base import SCORED_SQL, Tables, flow_sql, query

_RISING = f"""WITH {SCORED_SQL}, per AS (SELECT score, sum(label) AS pos, count(*) - sum(label) AS neg FROM scored GROUP BY score),
  cum AS (SELECT *, sum(neg) OVER (ORDER BY score) AS below, sum(pos) OVER (ORDER BY score DESC) AS tp,
  sum(pos + neg) OVER (ORDER BY score DESC) AS seen FROM per)"""


@query("e17_roc_auc", f"{_RISING} SELECT round(sum(pos * (below - neg / 2.0)) / (sum(pos) * sum(neg)), 9) AS auc FROM cum")
def _(t: Tables):
    return M.roc_auc(t.scored(), "score", "label").select(F.round("auc", 9).alias("auc"))


@query("e18_average_precision", f"{_RISING} SELECT round(sum(pos * (tp * 1.0::DOUBLE / seen)) / sum(pos), 9) AS average_precision FROM cum")
def _(t: Tables):
    return M.average_precision(t.scored(), "score", "label").select(F.round("average_precision", 9).alias("average_precision"))


@query("e16_wasserstein", """WITH per AS (SELECT value AS v, count(*) FILTER (WHERE event_type = 'click') AS a,
    count(*) FILTER (WHERE event_type = 'error') AS b FROM events WHERE event_type IN ('click', 'error') GROUP BY value),
  cum AS (SELECT v, sum(a) OVER (ORDER BY v) / (SELECT sum(a) FROM per)::DOUBLE AS fa, sum(b) OVER (ORDER BY v) / (SELECT sum(b) FROM per)::DOUBLE AS fb,
    lead(v) OVER (ORDER BY v) - v AS gap FROM per)
  SELECT round(sum(abs(fa - fb) * gap), 9) AS distance FROM cum""")
def _(t: Tables):
    return M.wasserstein(t("events"), "value", "event_type", "click", "error").select(F.round("distance", 9).alias("distance"))


@query("e19_benign_cutoff", f"""WITH {SCORED_SQL}, benign AS (SELECT score, row_number() OVER (ORDER BY score DESC) AS r, count(*) OVER () AS n FROM scored WHERE label = 0)
  SELECT score AS cutoff FROM benign WHERE r = CAST(floor(n * 0.1) AS BIGINT)""")
def _(t: Tables):
    return M.benign_cutoff(t.scored().filter("label = 0"), "score", 10.0)


@query("g03_kth_largest", f"""WITH {flow_sql()}, ranked AS (SELECT td, row_number() OVER (ORDER BY td DESC) AS r, count(*) OVER () AS n FROM flow)
  SELECT td AS cutoff FROM ranked WHERE r = CAST(floor(n * 0.001) AS BIGINT)""")
def _(t: Tables):
    return M.benign_cutoff(t.flow(), "td", 0.1)


@query("e20_confusion", f"""WITH {SCORED_SQL}, c AS (SELECT count(*) FILTER (WHERE score >= 2000 AND label = 1) AS tp,
  count(*) FILTER (WHERE score >= 2000 AND label = 0) AS fp, count(*) FILTER (WHERE score < 2000 AND label = 1) AS fn,
  count(*) FILTER (WHERE score < 2000 AND label = 0) AS tn FROM scored)
  SELECT *, round(tp * 1.0::DOUBLE / (tp + fp), 9) AS precision, round(tp * 1.0::DOUBLE / (tp + fn), 9) AS recall FROM c""")
def _(t: Tables):
    out = M.confusion(t.scored(), "score", "label", 2000.0)
    return out.withColumns({"precision": F.round("precision", 9), "recall": F.round("recall", 9)})


@query("e11_retrained_cutoff", """SELECT CAST(floor(quantile_cont(l_extendedprice, 0.99999)) AS BIGINT) AS cutoff, min(l_extendedprice) AS lowest,
  round(avg(l_extendedprice), 4) AS mean, max(l_extendedprice) AS highest FROM lineitem""")
def _(t: Tables):
    out = M.retrained_cutoff(t("lineitem"), "l_extendedprice")
    return out.withColumn("mean", F.round("mean", 4))


@query("e12_contamination_threshold", """WITH r AS (SELECT value, row_number() OVER (ORDER BY value) AS r, count(*) OVER () AS n FROM events)
  SELECT value AS threshold FROM r WHERE r = CAST(ceil(n * (1 - 0.1)) AS BIGINT)""")
def _(t: Tables):
    return M.rank_quantile(t("events"), "value", 1 - 0.1, name="threshold")


@query("e12_contamination_threshold_approximate", "SELECT count(*) AS n, true AS rank_is_near FROM events")
def _(t: Tables):
    """The share of values up to the threshold is 0.9 within the allowed error."""
    threshold = M.rank_quantile(t("events"), "value", 0.9, error=0.001, name="threshold")
    share = t("events").join(F.broadcast(threshold)).agg(F.count("*").alias("n"), F.avg((F.col("value") <= F.col("threshold")).cast("int")).alias("s"))
    return share.select("n", F.col("s").between(0.898, 0.902).alias("rank_is_near"))


@query("e13_date_histogram", """WITH local AS (SELECT ts + INTERVAL 1 HOUR AS l FROM events)
  SELECT CAST(epoch(time_bucket(INTERVAL 12 HOUR, l, TIMESTAMP '2024-01-01')) AS BIGINT) AS bucket, count(*) AS n FROM local GROUP BY 1""")
def _(t: Tables):
    out = M.date_histogram(t("events"), "ts", "Europe/Brussels")
    return out.select(F.unix_timestamp("bucket").alias("bucket"), "n")


@query("e14_score_histogram", """SELECT CAST(CASE WHEN value < 0 THEN 0 WHEN value >= 500 THEN 51 ELSE floor(value / 10) + 1 END AS BIGINT) AS bucket, count(*) AS n FROM events GROUP BY 1""")
def _(t: Tables):
    return M.score_histogram(t("events"), "value", 0.0, 500.0, 50).select(F.col("bucket").cast("bigint").alias("bucket"), "n")


@query("e15_class_location", f"""WITH {SCORED_SQL} SELECT label, round(median(score), 6) AS median, round(avg(score), 6) AS mean FROM scored GROUP BY label""")
def _(t: Tables):
    out = M.class_profile(t.scored(), ["score"], "label")
    return out.select("label", F.round("median", 6).alias("median"), F.round("mean", 6).alias("mean"))


@query("e23_class_profile", f"""WITH {flow_sql()}, cells AS (SELECT td > 100 AS flag, 'ipkt' AS feature, CAST(ipkt AS DOUBLE) AS v FROM flow UNION ALL
  SELECT td > 100, 'ibyt', CAST(ibyt AS DOUBLE) FROM flow UNION ALL SELECT td > 100, 'stos', CAST(stos AS DOUBLE) FROM flow)
  SELECT flag, feature, round(median(v), 6) AS median, round(avg(v), 6) AS mean FROM cells GROUP BY flag, feature""")
def _(t: Tables):
    flow = t.flow().withColumn("flag", F.col("td") > 100)
    out = M.class_profile(flow, ["ipkt", "ibyt", "stos"], "flag")
    return out.select("flag", "feature", F.round("median", 6).alias("median"), F.round("mean", 6).alias("mean"))


_PRED = """p AS (SELECT vec_id, label, CASE WHEN vec_id % 4 = 0 THEN (label + 1) % 10 ELSE label END AS prediction FROM embeddings)"""


def _predicted(t):
    return t("embeddings").select(
        "label", F.when(F.col("vec_id") % 4 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("prediction")
    )


@query("e21_multiclass_metrics", f"""WITH {_PRED}, c AS (SELECT k AS class, count(*) FILTER (WHERE label = k) AS actual,
  count(*) FILTER (WHERE label = k AND prediction = k) AS tp, count(*) FILTER (WHERE prediction = k) AS pp
  FROM p, (SELECT DISTINCT label AS k FROM embeddings) GROUP BY k)
  SELECT class, actual, round(tp * 1.0::DOUBLE / pp, 9) AS precision, round(tp * 1.0::DOUBLE / actual, 9) AS recall,
  round(2.0::DOUBLE * tp / (pp + actual), 9) AS f1 FROM c""")
def _(t: Tables):
    out = M.multiclass_metrics(_predicted(t))
    return out.select("class", "actual", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


@query("e21_regression_metrics", """WITH p AS (SELECT l_extendedprice AS y, l_quantity * 1500 AS f FROM lineitem)
  SELECT round(avg((y - f) * (y - f)) / 1e6, 4) AS mse, round(sqrt(avg((y - f) * (y - f))), 4) AS rmse, round(avg(abs(y - f)), 4) AS mae,
  round(1 - avg((y - f) * (y - f)) / var_pop(y), 9) AS r2 FROM p""")
def _(t: Tables):
    rows = t("lineitem").select(F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 1500).alias("prediction"))
    out = M.regression_metrics(rows)
    return out.select(F.round(F.col("mse") / 1e6, 4).alias("mse"), F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"), F.round("r2", 9).alias("r2"))
