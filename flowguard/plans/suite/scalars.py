"""Queries over column functions."""

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from flowguard.functions import scalar as S
from flowguard.operators.edges import cell_index, hash_params
from flowguard.plans.suite.base import VECTORS_SQL, Tables, flow_sql, query
from flowguard.session import scan_parallelism

FLOW = flow_sql()


@query("c01_parse_timestamp", """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN -1 ELSE CAST(epoch(o_orderdate) AS BIGINT) END AS sec FROM orders""")
def _(t: Tables):
    key = F.col("o_orderkey")
    text = (
        F.when(key % 4 == 0, F.date_format("o_orderdate", "dd/MM/yyyy HH:mm"))
        .when(key % 4 == 1, F.date_format("o_orderdate", "dd/MM/yyyy HH:mm:ss"))
        .when(key % 4 == 2, F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.concat(F.lit("bad "), key.cast("string")))
    )
    return t("orders").select("o_orderkey", F.coalesce(S.epoch_seconds(S.parse_timestamp(text)), F.lit(-1).cast("bigint")).alias("sec"))


@query("c02_epoch_seconds", "SELECT event_id AS id, CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM events")
def _(t: Tables):
    return t("events").select(F.col("event_id").alias("id"), S.epoch_seconds(F.col("ts")).alias("sec"))


@query("c04_slot_number", f"""WITH {FLOW} SELECT id, CAST(floor((sec - (SELECT arg_min(sec, id) FROM flow)) / 120) AS BIGINT) + 1 AS slot FROM flow""")
def _(t: Tables):
    from flowguard.operators.edges import with_slots

    return with_slots(t.flow().select("id", "sec"), "sec", S.slot_seconds("2m"), "id").select("id", "slot")


@query("c05_ipv4_to_long", """SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN -1 ELSE 167772160 + (c_custkey // 65536) * 65536
  + ((c_custkey // 256) % 256) * 256 + c_custkey % 256 END AS ip FROM customer""")
def _(t: Tables):
    k = F.col("c_custkey")
    part = lambda c: F.floor(c).cast("string")
    ip = F.concat_ws(".", F.lit("10"), part(k / 65536), part((k / 256) % 256), part(k % 256))
    ip = F.when(k % 9 == 0, F.concat(ip, F.lit(".1"))).otherwise(ip)
    return t("customer").select("c_custkey", F.coalesce(S.ipv4_to_long(ip), F.lit(-1).cast("bigint")).alias("ip"))


@query("c06_ipv6_low32", """SELECT c_custkey, CAST(CASE c_custkey % 4 WHEN 0 THEN 65536 + c_custkey WHEN 1 THEN c_custkey
  WHEN 2 THEN 16909056 + c_custkey % 256 ELSE -1 END AS BIGINT) AS ip FROM customer""")
def _(t: Tables):
    k = F.col("c_custkey")

    def groups(n):
        """The low 32 bits as the last two groups of an address: a group holds 16 bits."""
        return F.concat_ws(":", F.lower(F.hex(F.shiftrightunsigned(n, 16))), F.lower(F.hex(n.bitwiseAND(65535))))

    ip = (
        F.when(k % 4 == 0, F.concat(F.lit("2001:db8:0:0:0:0:"), groups(k + 65536))).when(k % 4 == 1, F.concat(F.lit("fe80::"), groups(k), F.lit("%eth0")))
        .when(k % 4 == 2, F.concat(F.lit("::ffff:1.2.3."), (k % 256).cast("string"))).otherwise(F.concat(F.lit("1::2::"), groups(k)))
    )
    return t("customer").select("c_custkey", F.coalesce(S.ip_to_long32(ip), F.lit(-1).cast("bigint")).alias("ip"))


@query("c07_ipv6_hextet_sum", "SELECT c_custkey, 8193 + 3512 + c_custkey AS ip FROM customer")
def _(t: Tables):
    ip = F.concat(F.lit("2001:db8::"), F.hex("c_custkey"))
    return t("customer").select("c_custkey", S.ipv6_hextet_sum(ip).alias("ip"))


@query("c09_port_number", "SELECT p_partkey, CASE p_partkey % 4 WHEN 3 THEN -1 ELSE p_partkey END AS port FROM part")
def _(t: Tables):
    k = F.col("p_partkey")
    text = (
        F.when(k % 4 == 0, k.cast("string")).when(k % 4 == 1, F.concat(F.lit("0x"), F.lower(F.hex(k))))
        .when(k % 4 == 2, k.cast("string")).otherwise(F.concat(F.lit("port"), k.cast("string")))
    )
    return t("part").select("p_partkey", F.coalesce(S.port_number(text), F.lit(-1).cast("bigint")).alias("port"))


@query("c12_syslog_fields", """SELECT event_id AS id, CAST(floor(epoch(ts)) AS BIGINT) - 126230400 AS sec,
  'host' || CAST(user_id AS VARCHAR) AS hostname, CASE WHEN event_id % 3 < 2 THEN event_type ELSE '' END AS appname,
  CASE WHEN event_id % 3 = 0 THEN json_extract_string(props, '$.k') ELSE '' END AS pid,
  'event number ' || CAST(event_id AS VARCHAR) || CASE WHEN event_id % 5 = 0 THEN chr(10) || 'second line: x' ELSE '' END AS message
  FROM events WHERE event_id % 11 <> 0""")
def _(t: Tables):
    line = F.when(F.col("id") % 11 == 0, F.concat(F.lit("12 "), F.col("line"))).otherwise(F.col("line"))
    line = F.when(F.col("id") % 5 == 0, F.concat(line, F.lit("\nsecond line: x"))).otherwise(line)
    parsed = t.lines().select("id", S.syslog_fields(line).alias("f")).filter("f is not null")
    return parsed.select(
        "id", S.epoch_seconds(F.col("f.timestamp")).alias("sec"), "f.hostname", "f.appname", "f.pid", "f.message"
    )


_HISTORY = "CASE event_id % 4 WHEN 0 THEN 'ShADadFf' WHEN 1 THEN '' WHEN 2 THEN 'Sr^' ELSE 'hAdDaFT' END"


@query("c13_history_one_hot", f"""WITH h AS (SELECT event_id AS id, rpad({_HISTORY}, 23, '-') AS p FROM events),
  c AS (SELECT id, unnest(range(1, 24)) AS pos, p FROM h WHERE id % 7 <> 0)
  SELECT id, CAST(sum((strpos('shadfrcgtwiqSHADFRCGTWIQ-^', substr(p, pos, 1)) - 1) * pos) AS BIGINT) AS weighted, CAST(count(*) AS BIGINT) AS ones
  FROM c GROUP BY id""")
def _(t: Tables):
    e = F.col("event_id")
    history = F.when(e % 4 == 0, "ShADadFf").when(e % 4 == 2, "Sr^").when(e % 4 == 3, "hAdDaFT")
    # Every seventh history is too long or has a letter of no alphabet: it is null, not cut.
    history = F.when(e % 14 == 0, F.repeat(F.lit("ShAD"), 10)).when(e % 7 == 0, "ShX").otherwise(history)
    # A row becomes 598 cells: ids are dealt over all cores before, and the sums need no other shuffle.
    ids = t("events").select("event_id").repartition(scan_parallelism(t.spark), "event_id")
    hot = ids.select(e.alias("id"), S.history_one_hot(history).alias("h"))
    # An inner explode would encode every history again to see that it is not null.
    cells = hot.select("id", F.posexplode_outer("h").alias("pos", "row")).filter("pos IS NOT NULL")
    cells = cells.select("id", "pos", F.posexplode_outer("row").alias("letter", "v"))
    return cells.groupBy("id").agg(
        F.sum(F.col("v") * F.col("letter") * (F.col("pos") + 1)).cast("bigint").alias("weighted"), F.sum("v").cast("bigint").alias("ones")
    )


@query("c14_one_hot_label", "SELECT vec_id AS id, array_to_string([CAST(label = i AS INTEGER) FOR i IN range(10)], ',') AS hot FROM embeddings")
def _(t: Tables):
    hot = F.transform(S.one_hot(F.col("label"), 10), lambda v: v.cast("int").cast("string"))
    return t.vectors().select("id", F.array_join(hot, ",").alias("hot"))


@query("c15_argmax", f"WITH {VECTORS_SQL} SELECT id, CAST(list_position(x, list_max(x)) - 1 AS INTEGER) AS best FROM vectors")
def _(t: Tables):
    return t.vectors().select("id", S.argmax(F.col("x")).alias("best"))


@query("c16_vector_round_trip", f"WITH {VECTORS_SQL} SELECT id, round(list_sum([x[i] * i FOR i IN range(1, 65)]), 6) AS weighted, CAST(len(x) AS INTEGER) AS n FROM vectors")
def _(t: Tables):
    back = t.vectors().select("id", vector_to_array(array_to_vector("x")).alias("x"))
    weighted = F.aggregate(F.transform("x", lambda v, i: v * (i + 1)), F.lit(0.0), lambda a, v: a + v)
    return back.select("id", F.round(weighted, 6).alias("weighted"), F.size("x").alias("n"))


@query("c19_cell_hash", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate::VARCHAR AS d, "
       + ", ".join(f"((l_partkey + l_suppkey * 347) * {hash_params(2, 1)[r]} + {hash_params(2, 1)[r + 2]}) % 1024 + {r * 1024} AS cell_{r}" for r in range(2))
       + " FROM lineitem")
def _(t: Tables):
    a, b = F.col("l_partkey"), F.col("l_suppkey")
    return t("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("d"),
        *[cell_index(a, b, r, 1024, hash_params(2, 1)).alias(f"cell_{r}") for r in range(2)],
    )


_BURST = "SELECT p_partkey, CAST(p_size AS DOUBLE) AS a, CAST(p_partkey % 7 AS DOUBLE) AS s, CAST(1 + p_partkey % 5 AS DOUBLE) AS t FROM part"


def _burst(t):
    k = F.col("p_partkey")
    return t("part").select("p_partkey", F.col("p_size").cast("double").alias("a"), (k % 7).cast("double").alias("s"), (1 + k % 5).cast("double").alias("t"))


@query("c20_burst_relative", f"""SELECT p_partkey, round(CASE WHEN s = 0 OR t = 1 THEN 0 ELSE power((a - s / t) * t, 2) / (s * (t - 1)) END, 6) AS score FROM ({_BURST})""")
def _(t: Tables):
    return _burst(t).select("p_partkey", F.round(S.burst_relative(F.col("a"), F.col("s"), F.col("t")), 6).alias("score"))


@query("c21_burst_filtered", f"""SELECT p_partkey, round(CASE WHEN s = 0 THEN 0 ELSE power(a + s - a * t, 2) / (s * (t - 1)) END, 6) AS score FROM ({_BURST}) WHERE t > 1""")
def _(t: Tables):
    return _burst(t).filter("t > 1").select("p_partkey", F.round(S.burst_filtered(F.col("a"), F.col("s"), F.col("t")), 6).alias("score"))


_PATH = """CASE WHEN p_size > 2 THEN 2 * (ln(p_size - 1) + 0.5772156649) - 2.0 * (p_size - 1) / p_size WHEN p_size = 2 THEN 1 ELSE 0 END"""


@query("c22_expected_path_length", f"SELECT p_partkey, round({_PATH}, 9) AS c FROM part")
def _(t: Tables):
    return t("part").select("p_partkey", F.round(S.expected_path_length(F.col("p_size")), 9).alias("c"))


@query("c23_isolation_score", f"SELECT p_partkey, round(CASE WHEN {_PATH} > 0 THEN power(2, -(p_partkey % 10) / ({_PATH})) ELSE 0.5 END, 9) AS score FROM part")
def _(t: Tables):
    return t("part").select("p_partkey", F.round(S.isolation_score(F.col("p_partkey") % 10, F.col("p_size")), 9).alias("score"))


_SHIFTED = "[x[i] - x[(i % 64) + 1] for i in range(1, 65)]"


def _pairs(t):
    rotated = F.concat(F.slice("x", 2, 63), F.slice("x", 1, 1))
    return t.vectors().withColumn("y", rotated)


@query("c24_row_errors", f"""WITH {VECTORS_SQL} SELECT id, round(list_sum([d * d for d in {_SHIFTED}]) / 64, 9) AS mse,
  round(list_sum([abs(d) for d in {_SHIFTED}]), 9) AS sae, round(2 * list_sum([abs(d) for d in {_SHIFTED}]), 9) AS sae_2d FROM vectors""")
def _(t: Tables):
    x, y = F.col("x"), F.col("y")
    return _pairs(t).select(
        "id", F.round(S.mean_square_error(x, y), 9).alias("mse"), F.round(S.sum_abs_error(x, y), 9).alias("sae"),
        F.round(S.sum_abs_error_2d(F.array(x, y), F.array(y, x)), 9).alias("sae_2d"),
    )


@query("c25_combined_error", f"""WITH {VECTORS_SQL}, e AS (SELECT id, list_sum([abs(d) for d in {_SHIFTED}]) AS zeek,
  list_sum([d * d for d in {_SHIFTED}]) AS flow FROM vectors)
  SELECT id, round(zeek + flow * (SELECT avg(zeek) / avg(flow) FROM e), 6) AS combined FROM e""")
def _(t: Tables):
    from flowguard.ml.dense import combined_error

    x, y = F.col("x"), F.col("y")
    errors = _pairs(t).select("id", S.sum_abs_error(x, y).alias("zeek"), (S.mean_square_error(x, y) * 64).alias("flow"))
    return combined_error(errors, "zeek", "flow").select("id", F.round("combined", 6).alias("combined"))


@query("c26_weight_arithmetic", f"""WITH {VECTORS_SQL} SELECT id, round(x[1] + x[2], 9) AS added, round(x[1] - x[2], 9) AS taken,
  0.0::DOUBLE AS zero, round(x[1] / 4, 9) AS quarter FROM vectors""")
def _(t: Tables):
    x, y = F.col("x"), F.col("y")
    return _pairs(t).select(
        "id", F.round(S.weights_add(x, y)[0], 9).alias("added"), F.round(S.weights_subtract(x, y)[0], 9).alias("taken"),
        (S.weights_zero(x)[0] + 0.0).alias("zero"), F.round(S.weights_divide(x, 4)[0], 9).alias("quarter"),
    )
