"""Queries over joins and result fusion."""

from pyspark.sql import functions as F

from flowguard.operators import correlate as C
from flowguard.operators import joins as J
from flowguard.plans.suite.base import RESULTS_SQL, VECTORS_SQL, Tables, flow_sql, query
from flowguard.schema import MODULES

_SIDES = f"""{flow_sql()}, conn AS (SELECT id AS ts, sa, da, sp, dp, 'uid' || CAST(id AS VARCHAR) AS uid, pr AS history FROM flow WHERE id % 3 = 0),
  dense AS (SELECT id, sa % 20 AS sa, da % 5 AS da, td FROM flow),
  side AS (SELECT ts, sa % 20 AS sa, da % 5 AS da, uid, history FROM conn WHERE sa % 20 < 15)"""


def _sides(t):
    """Flows and connections with many repeats per key."""
    flow = t.flow()
    flows = flow.select("id", (F.col("sa") % 20).alias("sa"), (F.col("da") % 5).alias("da"), F.lit(1).alias("sp"), F.lit(2).alias("dp"), "td")
    conn = flow.filter((F.col("id") % 3 == 0) & (F.col("sa") % 20 < 15)).select(
        F.col("id").alias("ts"), F.concat(F.lit("uid"), F.col("id").cast("string")).alias("uid"), (F.col("sa") % 20).alias("id.orig_h"),
        (F.col("da") % 5).alias("id.resp_h"), F.lit(1).alias("id.orig_p"), F.lit(2).alias("id.resp_p"), F.col("pr").alias("history"),
    )
    return flows, conn


@query("d01_merge_connections", f"""WITH {_SIDES}, latest AS (SELECT sa, da, arg_max(uid, ts) AS uid, arg_max(history, ts) AS history FROM side GROUP BY sa, da)
  SELECT d.id, d.sa, d.da, d.td, uid, history FROM dense d LEFT JOIN latest l ON l.sa = d.sa AND l.da = d.da""")
def _(t: Tables):
    return J.merge_connections(*_sides(t)).select("id", "sa", "da", "td", "uid", "history")


@query("d02_keep_last", f"""WITH {_SIDES} SELECT sa, da, arg_max(uid, ts) AS uid, max(ts) AS ts FROM side GROUP BY sa, da""")
def _(t: Tables):
    conn = _sides(t)[1].withColumnsRenamed({"id.orig_h": "sa", "id.resp_h": "da"}).select("sa", "da", "uid", "ts")
    return J.keep_last(conn, ["sa", "da"], "ts")


@query("d03_unmatched_connections", f"""WITH {_SIDES} SELECT uid FROM side WHERE (sa, da) NOT IN (SELECT sa, da FROM dense WHERE id % 7 <> 0 AND sa <> 3)""")
def _(t: Tables):
    flows, conn = _sides(t)
    conn = conn.withColumnsRenamed({"id.orig_h": "sa", "id.resp_h": "da"})
    return J.unmatched(conn, flows.filter((F.col("id") % 7 != 0) & (F.col("sa") != 3)), ["sa", "da"], "uid").select("uid")


@query("d04_unmatched_flows", f"""WITH {_SIDES} SELECT id FROM dense WHERE (sa, da) NOT IN (SELECT sa, da FROM side)""")
def _(t: Tables):
    flows, conn = _sides(t)
    return J.unmatched(flows, conn.withColumnsRenamed({"id.orig_h": "sa", "id.resp_h": "da"}), ["sa", "da"], "id").select("id")


@query("d05_rejoin_scores", f"""WITH {VECTORS_SQL} SELECT DISTINCT id, label, round(x[1] * 2, 9) AS score FROM vectors WHERE x[1] > 0""")
def _(t: Tables):
    rows = t.vectors()
    scores = rows.filter(F.col("x")[0] > 0).select("id", F.round(F.col("x")[0] * 2, 9).alias("score"))
    return J.rejoin_scores(rows.select("id", "label"), scores)


def _pick(m, field, sql_default):
    return f"coalesce(arg_min({field}, arrival) FILTER (WHERE module = '{m}'), {sql_default}) AS {m.lower()}_{field}"


_FUSED = ", ".join(_pick(m, "score", "-1") + ", " + _pick(m, "is_anomalous", "false") for m in MODULES)


@query("e06_fuse_results", f"""WITH {RESULTS_SQL} SELECT key, {_FUSED}, min(arrival) AS first_arrival FROM results GROUP BY key""")
def _(t: Tables):
    columns = []
    for m in MODULES:
        name = m.lower()
        columns.append(F.coalesce(F.col(f"{name}.score"), F.lit(-1.0)).alias(f"{name}_score"))
        columns.append(F.coalesce(F.col(f"{name}.is_anomalous"), F.lit(False)).alias(f"{name}_is_anomalous"))
    return C.fuse(t.results()).select("key", *columns, "first_arrival")


@query("e07_first_seen_flow", f"WITH {RESULTS_SQL} SELECT key, arg_min(features, arrival) AS first_features, arg_min(sa, arrival) AS sa FROM results GROUP BY key")
def _(t: Tables):
    fused = C.fuse(t.results(), flow=["features", "sa"])
    return fused.select("key", F.col("flow.features").alias("first_features"), F.col("flow.sa").alias("sa"))


_FIRST = f"""{RESULTS_SQL}, firsts AS (SELECT key, module, arg_min(score, arrival) AS score, arg_min(is_anomalous, arrival) AS flag,
  arg_min(features, arrival) AS features FROM results GROUP BY key, module)"""


@query("e08_shall_propagate", f"""WITH {_FIRST} SELECT key, bool_or(flag) AS propagate,
  bool_or(flag) AND bool_or(module IN ('AE', 'IFOREST')) AS propagate_strict FROM firsts GROUP BY key""")
def _(t: Tables):
    return C.fuse(t.results()).select(
        "key", C.shall_propagate().alias("propagate"), C.shall_propagate(True).alias("propagate_strict")
    )


@query("e09_completion_rules", f"""WITH {_FIRST} SELECT key, count(*) = 5 AS done_all,
  count(*) FILTER (WHERE module IN ('MIDAS', 'IFOREST')) = 2 AS done_midas_iforest,
  count(*) FILTER (WHERE module IN ('IFOREST', 'GANomaly')) = 2 AS done_iforest_ganomaly FROM firsts GROUP BY key""")
def _(t: Tables):
    return C.fuse(t.results()).select("key", *[C.complete(r).alias(f"done_{r.lower()}") for r in C.EARLY_RULES])


@query("e10_feature_source", f"""WITH {_FIRST} SELECT key, coalesce(max(features) FILTER (WHERE module = 'AE'),
  max(features) FILTER (WHERE module = 'IFOREST'), 'none') AS features FROM firsts GROUP BY key""")
def _(t: Tables):
    return C.fuse(t.results()).select("key", F.coalesce(C.model_features(), F.lit("none")).alias("features"))


_LINE = " || ',' || ".join(
    f"coalesce(max(CAST(CAST(floor(score) AS BIGINT) AS VARCHAR)) FILTER (WHERE module = '{m}'), 'None') || ',' || "
    f"coalesce(max(CASE WHEN flag THEN '1' ELSE '0' END) FILTER (WHERE module = '{m}'), 'None')"
    for m in MODULES
)


@query("c18_fused_csv", f"""WITH {_FIRST} SELECT key, key || ',x,' || {_LINE} || coalesce(',' || coalesce(max(features) FILTER (WHERE module = 'AE'),
  max(features) FILTER (WHERE module = 'IFOREST')), '') AS line FROM firsts GROUP BY key""")
def _(t: Tables):
    whole = t.results().withColumn("score", F.floor("score").cast("bigint"))
    return C.fuse(whole).select("key", C.fused_csv([F.col("key"), F.lit("x")]).alias("line"))


@query("a20_fused_messages", f"""WITH {_FIRST}, fused AS (SELECT key, key || ',x,' || {_LINE} || coalesce(',' || coalesce(max(features) FILTER (WHERE module = 'AE'),
  max(features) FILTER (WHERE module = 'IFOREST')), '') AS line, bool_or(flag) AS send FROM firsts GROUP BY key),
  ordered AS (SELECT f.*, (SELECT min(arrival) FROM results r WHERE r.key = f.key) AS pos FROM fused f)
  SELECT 'AD-aggr-message-' || CAST(row_number() OVER (ORDER BY pos) - 1 AS VARCHAR) AS key, line AS value FROM ordered WHERE send""")
def _(t: Tables):
    from flowguard.sources.writers import keyed_messages

    whole = t.results().withColumn("score", F.floor("score").cast("bigint"))
    fused = C.fuse(whole).filter(C.shall_propagate())
    lines = fused.select("first_arrival", C.fused_csv([F.col("key"), F.lit("x")]).alias("line"))
    return keyed_messages(lines, "line", "first_arrival", "AD-aggr-message-")


@query("t06_first_result_wins", f"WITH {_FIRST} SELECT key, module, features FROM firsts WHERE module = 'MIDAS'")
def _(t: Tables):
    fused = C.fuse(t.results()).filter("midas is not null")
    return fused.select("key", F.lit("MIDAS").alias("module"), "midas.features")
