"""Queries over the edge burst scorers."""

from pyspark.sql import functions as F

from flowguard.functions.scalar import slot_number
from flowguard.operators import edges as E
from flowguard.plans.suite.base import EDGE_SQL, Tables, flow_sql, query

_P = E.hash_params(2, 1)
_TAIL = ["seq", "src", "dst", "slot"]


def _cells_sql(kinds: str, exact: bool) -> str:
    """Touched cells of every event, with the slot the scorer is in."""
    if exact:
        cell = "CAST(k.kind AS VARCHAR) || '/' || CAST(a AS VARCHAR) || '/' || CAST(b AS VARCHAR)"
        rows = "(VALUES (0)) r(row)"
    else:
        cell = (
            "CAST(k.kind AS VARCHAR) || '/' || CAST(((a + b * 347) * (CASE r.row WHEN 0 THEN %d ELSE %d END)"
            " + (CASE r.row WHEN 0 THEN %d ELSE %d END)) %% 1024 + r.row * 1024 AS VARCHAR)" % (_P[0], _P[1], _P[2], _P[3])
        )
        rows = "(VALUES (0), (1)) r(row)"
    return f"""{EDGE_SQL}, seen AS (SELECT *, greatest(1, max(slot) OVER (ORDER BY seq)) AS now FROM edge),
      keyed AS (SELECT seq, src, dst, slot, now, kind, CASE kind WHEN 2 THEN dst ELSE src END AS a,
        CASE kind WHEN 0 THEN dst ELSE 0 END AS b FROM seen, (VALUES {kinds}) v(kind)),
      touched AS (SELECT seq, src, dst, slot, now, k.kind, r.row, {cell} AS cell FROM keyed k, {rows}),
      counted AS (SELECT *, count(*) OVER (PARTITION BY cell, now ORDER BY seq) AS inslot,
        count(*) OVER (PARTITION BY cell ORDER BY seq) AS total FROM touched)"""


_CHI = "CASE WHEN s = 0 OR t = 1 THEN 0 ELSE power((a - s / t) * t, 2) / (s * (t - 1)) END"


def _plain_sql(exact):
    return f"""WITH {_cells_sql('(0)', exact)}, least AS (SELECT seq, src, dst, slot, CAST(slot AS DOUBLE) AS t,
        CAST(min(inslot) AS DOUBLE) AS a, CAST(min(total) AS DOUBLE) AS s FROM counted GROUP BY seq, src, dst, slot)
      SELECT seq, src, dst, slot, round({_CHI}, 6) AS score FROM least"""


def _relational_sql(exact):
    return f"""WITH {_cells_sql('(0), (1), (2)', exact)},
      ranks AS (SELECT now, row_number() OVER (ORDER BY now) AS rank FROM (SELECT DISTINCT now FROM seen)),
      per_slot AS (SELECT cell, now, rank, count(*) AS n FROM counted JOIN ranks USING (now) GROUP BY cell, now, rank),
      carried AS (SELECT p.cell, p.now, coalesce(sum(q.n * power(0.5, p.rank - q.rank)), 0) AS decayed
        FROM per_slot p LEFT JOIN per_slot q ON q.cell = p.cell AND q.rank < p.rank GROUP BY p.cell, p.now),
      least AS (SELECT seq, src, dst, slot, kind, CAST(c.now AS DOUBLE) AS t, min(decayed + inslot) AS a,
        CAST(min(total) AS DOUBLE) AS s FROM counted c JOIN carried d ON d.cell = c.cell AND d.now = c.now
        GROUP BY seq, src, dst, slot, kind, c.now)
      SELECT seq, src, dst, slot, round(max({_CHI}), 6) AS score FROM least GROUP BY seq, src, dst, slot"""


_F = 5.0  # merge threshold low enough for both branches to occur


def _filtered_sql(threshold=_F, slot=3600, select="seq, src, dst, slot, round(max(score) / 3, 6) AS score_third"):
    """The recursion over slots of one entity, written as a recursive query."""
    chi = "CASE WHEN {s} = 0 THEN 0 ELSE power({a} + {s} - {a} * {t}, 2) / ({s} * ({t} - 1)) END"
    grown = f"""CASE WHEN r.score < {threshold} THEN r.total + r.cur * (1 - power(0.5, p.rank - r.rank)) / 0.5
      ELSE r.total * exp(p.growth - r.growth) END"""
    return f"""WITH RECURSIVE {_cells_sql('(0), (1), (2)', True).replace("/ 3600)", f"/ {slot})")},
      ranks AS (SELECT now, row_number() OVER (ORDER BY now) AS rank,
        coalesce(sum(CASE WHEN now > 1 THEN ln(1 + 1.0::DOUBLE / (now - 1)) ELSE 0 END)
          OVER (ORDER BY now ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS growth
        FROM (SELECT DISTINCT now FROM seen)),
      per_slot AS (SELECT cell, now, rank, growth, count(*) AS n FROM counted JOIN ranks USING (now) GROUP BY ALL),
      carried AS (SELECT p.cell, p.now, p.rank, p.growth, p.n, coalesce(sum(q.n * power(0.5, p.rank - q.rank)), 0) AS decayed
        FROM per_slot p LEFT JOIN per_slot q ON q.cell = p.cell AND q.rank < p.rank GROUP BY ALL),
      steps AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY rank) AS i, decayed + n AS cur FROM carried),
      walk(cell, i, now, rank, growth, cur, total, score) AS (
        SELECT cell, i, now, rank, growth, cur, 0.0::DOUBLE, 0.0::DOUBLE FROM steps WHERE i = 1
        UNION ALL SELECT cell, i, now, rank, growth, cur, total, {chi.format(s='total', a='cur', t='now')} FROM
          (SELECT p.cell, p.i, p.now, p.rank, p.growth, p.cur, {grown} AS total FROM walk r JOIN steps p ON p.cell = r.cell AND p.i = r.i + 1)),
      scored AS (SELECT c.seq, c.src, c.dst, c.slot, {chi.format(s='w.total', a='(d.decayed + c.inslot)', t='c.now')} AS score
        FROM counted c JOIN carried d ON d.cell = c.cell AND d.now = c.now JOIN walk w ON w.cell = c.cell AND w.now = c.now)
      SELECT {select} FROM scored GROUP BY seq, src, dst, slot"""


@query("w08_filtered_burst_exact", _filtered_sql())
def _(t: Tables):
    # A third, because scores are often dyadic fractions that sit exactly on rounding ties.
    scored = E.filtered_burst(t.edge(), mode="exact", threshold=_F)
    return scored.select(*_TAIL, F.round(F.col("score") / 3, 6).alias("score_third"))


@query("w08_filtered_burst_sketch")
def _(t: Tables):
    return E.filtered_burst(t.edge()).select(*_TAIL, F.round("score", 6).alias("score"))


for _mode in ("sketch", "exact"):

    @query(f"w06_plain_burst_{_mode}", _plain_sql(_mode == "exact"))
    def _(t: Tables, mode=_mode):
        return E.plain_burst(t.edge(), mode=mode).select(*_TAIL, F.round("score", 6).alias("score"))

    @query(f"w07_relational_burst_{_mode}", _relational_sql(_mode == "exact"))
    def _(t: Tables, mode=_mode):
        return E.relational_burst(t.edge(), mode=mode).select(*_TAIL, F.round("score", 6).alias("score"))


@query("t09_late_events_slot", f"""WITH {EDGE_SQL}, late AS (SELECT seq, CASE WHEN seq % 10 = 0 THEN greatest(slot - 3, 1) ELSE slot END AS slot FROM edge)
  SELECT seq, slot, max(slot) OVER (ORDER BY seq) AS now FROM late""")
def _(t: Tables):
    slot = F.when(F.col("seq") % 10 == 0, F.greatest(F.col("slot") - 3, F.lit(1))).otherwise(F.col("slot"))
    late = t.edge().select("seq", slot.cast("bigint").alias("slot"))
    return E.observed_slot(late, "seq")


@query("t03_tumbling_slots", f"""WITH {EDGE_SQL} SELECT slot, count(*) AS n FROM edge GROUP BY slot""")
def _(t: Tables):
    return t.edge().groupBy("slot").agg(F.count("*").alias("n"))


@query("t12_instances", f"""WITH {flow_sql()} SELECT instance, CAST(floor((sec - (SELECT arg_min(sec, id) FROM flow)) / len) AS BIGINT) + 1 AS slot,
  count(*) AS n FROM flow, (VALUES ('1min', 60), ('2min', 120), ('5min', 300)) v(instance, len) GROUP BY 1, 2""")
def _(t: Tables):
    flow = t.flow().select("id", "sec")
    copies = E.with_instances(flow, {"1min": 60, "2min": 120, "5min": 300})
    origin = flow.agg(F.min_by("sec", "id").alias("origin"))
    slots = copies.join(F.broadcast(origin)).withColumn("slot", slot_number(F.col("sec"), F.col("origin"), F.col("slot_len")))
    return slots.groupBy("instance", "slot").agg(F.count("*").alias("n"))


_INSTANCES = {"10min": 600, "20min": 1200, "1hour": 3600}


@query("t12_instance_scores", " UNION ALL ".join(
    f"SELECT * FROM ({_filtered_sql(_F, length, select=f"'{name}' AS instance, seq, slot, round(max(score) / 3, 6) AS score_third")})" for name, length in _INSTANCES.items()))
def _(t: Tables):
    """Every event's score in three instances of different slot lengths, side by side."""
    edges = t.flow().select(F.col("id").alias("seq"), F.col("sa").alias("src"), F.col("da").alias("dst"), "sec")
    copies = E.with_instances(edges, _INSTANCES)
    origin = edges.agg(F.min_by("sec", "seq").alias("origin"))
    slotted = copies.join(F.broadcast(origin)).withColumn("slot", slot_number(F.col("sec"), F.col("origin"), F.col("slot_len")))
    scored = E.filtered_burst(slotted, keys=["instance"], mode="exact", threshold=_F)
    return scored.select("instance", "seq", "slot", F.round(F.col("score") / 3, 6).alias("score_third"))


@query("t11_cutoff_precedence", """SELECT p_partkey, CAST(CASE WHEN p_partkey % 3 = 0 THEN p_size WHEN p_partkey % 3 = 1 THEN 5
  ELSE CASE p_partkey % 4 WHEN 0 THEN 7062069 WHEN 1 THEN 1387058 WHEN 2 THEN 9114476 ELSE 8759679 END END AS BIGINT) AS cutoff FROM part""")
def _(t: Tables):
    k = F.col("p_partkey")
    stored = F.when(k % 3 == 0, F.col("p_size").cast("string")).otherwise("broken")
    configured = F.when(k % 3 != 2, "5")
    label = F.when(k % 4 == 0, "1min").when(k % 4 == 1, "2min").when(k % 4 == 2, "5min").otherwise("1sec")
    return t("part").select("p_partkey", E.cutoff_for(stored, configured, label).alias("cutoff"))
