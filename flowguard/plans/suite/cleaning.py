"""Queries over filters, null handling, categories and plain aggregates."""

from pyspark.sql import functions as F

from flowguard.functions import scalar as S
from flowguard.operators import clean
from flowguard.plans.suite.base import Tables, flow_sql, query

FLOW = flow_sql()


@query("b01_numeric_casts", """SELECT event_id AS id, CASE WHEN event_id % 4 = 0 THEN -1 ELSE CAST(floor(value) AS INTEGER) END AS n,
  value AS td FROM events""")
def _(t: Tables):
    text = F.when(F.col("event_id") % 4 == 0, "n/a").otherwise(F.floor("value").cast("string"))
    raw = t("events").select(F.col("event_id").alias("id"), text.alias("n"), F.col("value").cast("string").alias("td"))
    return clean.cast_columns(raw, {"n": "int", "td": "double"}).fillna(-1, ["n"])


@query("b02_keep_original", f"""WITH {FLOW} SELECT id, pr AS pr_original, CAST(rank AS BIGINT) AS pr FROM flow
  JOIN (SELECT pr AS p, row_number() OVER (ORDER BY pr) - 1 AS rank FROM (SELECT DISTINCT pr FROM flow)) d ON p = pr""")
def _(t: Tables):
    from flowguard.ml.features import encode_column

    return encode_column(t.flow().select("id", "pr"), "pr", order="alphabetAsc")[0].withColumn("pr", F.col("pr").cast("bigint"))


@query("b03_deny_list", f"WITH {FLOW} SELECT id, pr FROM flow WHERE pr NOT IN ('error', 'view')")
def _(t: Tables):
    return clean.deny(t.flow().select("id", "pr"), "pr", ["error", "view"])


@query("b04_missing_marker", "SELECT event_id AS id, 'ShA' AS zeek FROM events WHERE event_id % 3 <> 0")
def _(t: Tables):
    zeek = F.when(F.col("event_id") % 3 == 0, clean.MISSING_HISTORY).otherwise("ShA")
    return clean.has_history(t("events").select(F.col("event_id").alias("id"), zeek.alias("zeek")))


@query("b05_allowed_values", f"WITH {FLOW} SELECT id, stos FROM flow WHERE stos IN (0, 1, 2, 3)")
def _(t: Tables):
    return clean.allow(t.flow().select("id", "stos"), "stos", clean.ALLOWED_STOS)


@query("b06_constant_override", f"WITH {FLOW} SELECT id, pr AS pr_original, '...APRS.' AS pr FROM flow")
def _(t: Tables):
    return clean.override(t.flow().select("id", "pr"), "pr", clean.FLAG_OVERRIDE, "pr_original").select("id", "pr_original", "pr")


@query("b07_fixed_columns", f"WITH {FLOW} SELECT id, sa, da, td, ipkt, ibyt FROM flow")
def _(t: Tables):
    return t.flow().drop("sec", "sp", "dp", "pr", "stos").select("id", "sa", "da", "td", "ipkt", "ibyt")


_HOLES = """holes AS (SELECT c_custkey, CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_name END AS c_name,
    CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal, c_mktsegment, 'x' AS fixed FROM customer)"""


def _holes(t):
    return t("customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 6 != 0, F.col("c_name")).alias("c_name"),
        F.when(F.col("c_custkey") % 10 != 0, F.col("c_acctbal")).alias("c_acctbal"), "c_mktsegment", F.lit("x").alias("fixed"),
    )


@query("b08_drop_null_rows", f"WITH {_HOLES} SELECT * FROM holes WHERE c_name IS NOT NULL AND c_acctbal IS NOT NULL")
def _(t: Tables):
    return _holes(t).na.drop("any")


@query("b09_drop_null_columns", f"WITH {_HOLES} SELECT c_custkey, c_mktsegment, fixed FROM holes")
def _(t: Tables):
    return clean.drop_null_columns(_holes(t))


@query("b10_drop_constant_columns", f"WITH {_HOLES} SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM holes WHERE c_acctbal IS NOT NULL")
def _(t: Tables):
    return clean.drop_constant_columns(_holes(t)).filter("c_acctbal is not null")


@query("b11_null_fill", f"WITH {_HOLES} SELECT c_custkey, coalesce(c_name, '0') AS c_name, coalesce(c_acctbal, 0) AS c_acctbal FROM holes")
def _(t: Tables):
    return _holes(t).na.fill({"c_name": "0", "c_acctbal": 0.0}).select("c_custkey", "c_name", "c_acctbal")


@query("b12_null_profile", f"""WITH {_HOLES} SELECT count(*) - count(c_custkey) AS c_custkey, count(*) - count(c_name) AS c_name,
  count(*) - count(c_acctbal) AS c_acctbal, count(*) - count(c_mktsegment) AS c_mktsegment, count(*) - count(fixed) AS fixed FROM holes""")
def _(t: Tables):
    return clean.null_counts(_holes(t))


@query("b15_threshold_flag", "SELECT event_id AS id, value > 55.5 AS above, value >= 55.5 AS at_least, value < 55.5 AS below FROM events")
def _(t: Tables):
    score = F.col("value")
    return t("events").select(
        F.col("event_id").alias("id"), S.above(score, 55.5).alias("above"), S.above(score, 55.5, ">=").alias("at_least"),
        S.above(score, 55.5, "<").alias("below"),
    )


@query("b16_anomalies_only", "SELECT event_id AS id, value AS score FROM events WHERE value > 100")
def _(t: Tables):
    scored = t("events").select(F.col("event_id").alias("id"), F.col("value").alias("score"))
    return scored.filter(S.above(F.col("score"), 100.0))


@query("b17_skip_context_rows", f"""WITH {FLOW} SELECT id, round(m, 9) AS td_600_mean FROM (SELECT id, avg(td) OVER (ORDER BY sec
  RANGE BETWEEN 600 PRECEDING AND CURRENT ROW) AS m FROM flow) WHERE id >= 200""")
def _(t: Tables):
    from flowguard.operators.windows import trailing_means

    flow = t.flow().withColumn("is_context", F.col("id") < 200)
    out = trailing_means(flow, ["td"], (600,))
    return out.filter("not is_context").select("id", F.round("td_600_mean", 9).alias("td_600_mean"))


@query("e01_row_count", "SELECT count(*) AS n FROM events")
def _(t: Tables):
    return t("events").agg(F.count("*").alias("n"))


@query("e03_distinct_rows", "SELECT DISTINCT user_id AS sa, event_type AS pr FROM events")
def _(t: Tables):
    return t.flow().select("sa", "pr").distinct()


@query("e03_distinct_classes", "SELECT count(DISTINCT label) AS n FROM embeddings")
def _(t: Tables):
    return t("embeddings").agg(F.count_distinct("label").alias("n"))


@query("e04_distinct_counts", f"""WITH {FLOW} SELECT 'sa' AS "column", count(DISTINCT sa) AS n_distinct FROM flow UNION ALL
  SELECT 'pr', count(DISTINCT pr) FROM flow UNION ALL SELECT 'sp', count(DISTINCT sp) FROM flow""")
def _(t: Tables):
    return clean.distinct_counts(t.flow(), ["sa", "pr", "sp"])


@query("e05_unseen_categories", "SELECT DISTINCT event_type FROM events WHERE event_type NOT IN ('click', 'view')")
def _(t: Tables):
    return clean.unseen(t("events"), "event_type", ["click", "view"])


_KNOWN = ["ECONOMIC", "STANDART", "LARGE", "SMALLER", "PROMO"]


@query("c10_nearest_category", f"""WITH known(k, i) AS (VALUES {', '.join(f"('{k}', {i})" for i, k in enumerate(_KNOWN))}),
  pick AS (SELECT p_type, arg_min(k, levenshtein(p_type, k) * 100 + i) AS best FROM (SELECT DISTINCT p_type FROM part), known GROUP BY 1)
  SELECT p_partkey, best AS p_type FROM part JOIN pick USING (p_type)""")
def _(t: Tables):
    return t("part").select("p_partkey", clean.nearest_known(F.col("p_type"), _KNOWN).alias("p_type"))


@query("c10_nearest_of_many", """WITH known AS (SELECT p_name AS k, min(p_partkey) AS i FROM part WHERE p_partkey % 3 = 0 GROUP BY 1),
  asked AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN substr(p_name, 2) WHEN 2 THEN p_name || 'xy' ELSE p_type END AS v FROM part),
  near AS (SELECT v, arg_min(k, (levenshtein(v, k), i)) AS k FROM (SELECT DISTINCT v FROM asked), known GROUP BY v)
  SELECT p_partkey, k AS v FROM asked JOIN near USING (v)""")
def _(t: Tables):
    """A class list that grows with the table; values equal, near and far from it."""
    known = t("part").filter("p_partkey % 3 = 0").select(F.col("p_name").alias("category"), F.col("p_partkey").alias("order"))
    name, k = F.col("p_name"), F.col("p_partkey") % 4
    asked = t("part").select("p_partkey", F.when(k == 0, name).when(k == 1, F.substring(name, F.lit(2), F.length(name))).when(k == 2, F.concat(name, F.lit("xy"))).otherwise(F.col("p_type")).alias("v"))
    return clean.nearest_category(asked, "v", known)


@query("c08_shared_address_codes", """WITH a AS (SELECT event_id AS id,
    CASE WHEN user_id % 2 = 0 THEN '10.0.0.' || CAST(user_id % 256 AS VARCHAR) ELSE 'fe80::' || CAST(user_id AS VARCHAR) END AS sa,
    CASE WHEN event_id % 3 = 0 THEN 'fe80::' || CAST(event_id % 50 AS VARCHAR) ELSE '192.168.1.' || CAST(event_id % 50 AS VARCHAR) END AS da FROM events),
  used AS (SELECT sa AS v, id * 2 AS pos FROM a UNION ALL SELECT da, id * 2 + 1 FROM a),
  codes AS (SELECT v, row_number() OVER (ORDER BY min(pos)) - 1 AS code FROM used WHERE v LIKE 'fe80%' GROUP BY v)
  SELECT a.id, CASE WHEN a.sa LIKE '10.%' THEN 167772160.0 + CAST(split_part(a.sa, '.', 4) AS DOUBLE) ELSE CAST(s.code AS DOUBLE) END AS sa,
    CASE WHEN a.da LIKE '192.%' THEN 3232235776.0 + CAST(split_part(a.da, '.', 4) AS DOUBLE) ELSE CAST(d.code AS DOUBLE) END AS da
  FROM a LEFT JOIN codes s ON s.v = a.sa LEFT JOIN codes d ON d.v = a.da""")
def _(t: Tables):
    text = lambda c: c.cast("string")
    user, event = F.col("user_id"), F.col("event_id")
    sa = F.when(user % 2 == 0, F.concat(F.lit("10.0.0."), text(user % 256))).otherwise(F.concat(F.lit("fe80::"), text(user)))
    da = F.when(event % 3 == 0, F.concat(F.lit("fe80::"), text(event % 50))).otherwise(F.concat(F.lit("192.168.1."), text(event % 50)))
    raw = t("events").select(event.alias("id"), sa.alias("sa"), da.alias("da"))
    return clean.encode_addresses(raw)


def _positions(rows):
    """Rows with the place they have in the frame's order."""
    from flowguard.operators.scan import running
    from flowguard.session import checkpointed

    placed = checkpointed(rows.withColumn("_at", F.monotonically_increasing_id()))
    return running(placed, [], "_at", {"pos": ("sum", F.lit(1).cast("bigint"))}).drop("_at")


@query("g01_sort_by_source_time", f"WITH {FLOW} SELECT id, sa, sec, row_number() OVER (ORDER BY sa, sec, id) AS pos FROM flow")
def _(t: Tables):
    return _positions(t.flow().select("id", "sa", "sec").orderBy("sa", "sec", "id"))


@query("g02_sort_by_time", f"WITH {FLOW} SELECT id, sec, row_number() OVER (ORDER BY sec, id) AS pos FROM flow")
def _(t: Tables):
    return _positions(t.flow().select("id", "sec").orderBy("sec", "id"))


@query("g05_shuffle_rows", f"WITH {FLOW} SELECT count(*) AS n, count(DISTINCT id) AS ids, count(*) AS last_place, true AS mixed FROM flow")
def _(t: Tables):
    """All rows are there, at places that have nothing to do with their ids."""
    shuffled = _positions(t.flow().select("id").orderBy(F.rand(7)))
    return shuffled.agg(
        F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.max("pos").alias("last_place"), (F.abs(F.corr("id", "pos")) < 0.1).alias("mixed"))


@query("g04_last_rows", f"WITH {FLOW} SELECT id, td FROM flow ORDER BY id DESC LIMIT 400")
def _(t: Tables):
    from flowguard.operators.windows import last_rows

    return last_rows(t.flow().select("id", "td"), 400)


@query("d08_tenant_lookup", """SELECT c_custkey, n_nationkey AS partition FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def _(t: Tables):
    from flowguard.operators.joins import with_tenant_partition

    rows = t("customer").select("c_custkey", F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("tenant_id"))
    tenants = t("nation").select(F.col("n_name").alias("tenant_id"), F.col("n_nationkey").alias("partition"))
    return with_tenant_partition(rows, tenants, "c_custkey").select("c_custkey", "partition")
