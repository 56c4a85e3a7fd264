"""Queries over sources, parsing and payloads."""

from pyspark.sql import functions as F

from flowguard.functions import scalar as S
from flowguard.operators import clean
from flowguard.plans.suite.base import FLOW_CSV, VECTORS_SQL, Tables, flow_sql, query
from flowguard.sources import parse, readers, writers


@query("a04_tenant_partition", """SELECT event_id AS id, user_id FROM events
  WHERE user_id % 25 IN (SELECT n_nationkey FROM nation WHERE n_name = 'NATION_7')""")
def _(t: Tables):
    records = t("events").withColumn("partition", (F.col("user_id") % 25).cast("int"))
    tenants = t("nation").select(F.col("n_name").alias("tenant_id"), F.col("n_nationkey").alias("partition"))
    return readers.tenant_partition(records, tenants, "NATION_7").select(F.col("event_id").alias("id"), "user_id")


@query("a05_utf8_decode", """SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE text END AS value FROM documents""")
def _(t: Tables):
    raw = F.encode("text", "UTF-8")
    broken = F.concat(raw, F.unhex(F.lit("FF")))
    records = t("documents").select("doc_id", F.when(F.col("doc_id") % 7 == 0, broken).otherwise(raw).alias("value"))
    return parse.decode(records)


@query("a06_json_decode", """SELECT event_id AS id,
  CASE WHEN event_id % 5 = 0 THEN -1 ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events""")
def _(t: Tables):
    value = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("not json "), F.col("props"))).otherwise(F.col("props"))
    return t("events").select(F.col("event_id").alias("id"), F.coalesce(parse.json_or_null(value, "k bigint")["k"], F.lit(-1).cast("bigint")).alias("k"))


@query("a07_csv_fields_48", """SELECT event_id AS id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts,
  '10.1.0.' || CAST(event_id % 50 AS VARCHAR) AS da, upper(event_type) AS pr, '...APRS.' AS flg,
  CAST(event_id % 5 AS BIGINT) AS stos, CAST(json_extract_string(props, '$.k') AS BIGINT) AS ipkt,
  CAST(floor(value * 100) AS BIGINT) AS ibyt, '0' AS tr FROM events""")
def _(t: Tables):
    flow = parse.parse_flow(t.messages(48), 48, keep=["id"])
    flow = clean.cast_columns(flow, {"stos": "bigint", "ipkt": "bigint", "ibyt": "bigint"})
    return flow.select("id", "ts", "da", "pr", "flg", "stos", "ipkt", "ibyt", "tr")


@query("a07_csv_fields_71", """SELECT event_id AS id, upper(event_type) AS pr, 'ShADadFf' AS zeek, '0' AS pktips,
  '0' AS flgu FROM events""")
def _(t: Tables):
    return parse.parse_flow(t.messages(71), 71, keep=["id"]).select("id", "pr", "zeek", "pktips", "flgu")


@query("a07_csv_fields_12", """SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS ipkt, l_returnflag AS pr,
  CAST(l_suppkey AS VARCHAR) AS da FROM lineitem""")
def _(t: Tables):
    text = lambda c: F.col(c).cast("string")
    value = F.concat_ws(
        ",", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"), F.lit(""), F.lit("0"), text("l_partkey"), text("l_suppkey"),
        F.lit("1"), F.lit("2"), F.col("l_returnflag"), F.col("l_linestatus"), F.lit("0"),
        F.col("l_quantity").cast("bigint").cast("string"), F.lit("5"),
    )
    flow = parse.parse_flow(t("lineitem").select("l_orderkey", "l_linenumber", value.alias("value")), 12,
                            keep=["l_orderkey", "l_linenumber"])
    return flow.select("l_orderkey", "l_linenumber", F.col("ipkt").try_cast("bigint").alias("ipkt"), "pr", "da")


@query("a08_edge_message", """SELECT event_id AS id, CAST(floor(epoch(ts)) AS BIGINT) AS sec,
  '10.0.' || CAST(user_id // 256 AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR) AS source,
  '10.1.0.' || CAST(event_id % 50 AS VARCHAR) AS destination FROM events""")
def _(t: Tables):
    fields = t.messages(48).select("id", *parse.edge_fields(F.col("value")))
    return fields.select("id", S.epoch_seconds(F.col("ts")).alias("sec"), "source", "destination")


@query("a09_replay_messages", """SELECT 'demo-message-' || CAST(row_number() OVER (ORDER BY doc_id) - 1 AS VARCHAR) AS key,
  text AS value FROM documents""")
def _(t: Tables):
    return writers.keyed_messages(t("documents"), "text", "doc_id", "demo-message-")


@query("a13_envelope_message", """SELECT event_id AS id, json_extract_string(props, '$.k') AS message FROM events""")
def _(t: Tables):
    envelope = F.to_json(F.struct(F.lit("filebeat").alias("agent"), F.get_json_object("props", "$.k").alias("message")))
    return t("events").select(F.col("event_id").alias("id"), parse.envelope_message(envelope).alias("message"))


@query("a14_history_scan", f"""SELECT event_id AS id, {FLOW_CSV} AS raw FROM events
  WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 10 DAY AND event_id % 9 <> 0""")
def _(t: Tables):
    docs = t.messages(48).join(t("events").select(F.col("event_id").alias("id"), "ts"), "id")
    docs = docs.withColumn("raw", F.when(F.col("id") % 9 != 0, F.col("value")))
    now = F.expr("timestamp_ntz'2024-01-31 00:00:00'")
    return readers.history_scan(docs, "ts", "raw", now, "10 DAYS").select("id", "raw")


@query("a15_labelled_vectors", """SELECT p_partkey AS id, CAST(p_size AS DOUBLE) AS f0, p_retailprice AS f1,
  CAST(p_partkey AS DOUBLE) AS f2, CAST(p_size % 3 AS DOUBLE) AS label FROM part""")
def _(t: Tables):
    from pyspark.ml.functions import vector_to_array

    frame = t("part").withColumn("y", F.col("p_size") % 3)
    pairs = readers.labelled_vectors(frame, ["p_size", "p_retailprice", "p_partkey"], "y")
    x = vector_to_array("features")
    return pairs.select(
        x[2].cast("bigint").alias("id"), x[0].alias("f0"), x[1].alias("f1"), x[2].alias("f2"), "label"
    )


@query("a17_feature_label_pairs", f"""WITH {VECTORS_SQL}, cells AS (SELECT CASE WHEN label BETWEEN 0 AND 9 THEN label ELSE -1 END AS class, unnest(x) AS v, unnest(range(len(x))) AS j FROM vectors)
  SELECT CAST(class AS INTEGER) AS class, CAST(j AS INTEGER) AS j, count(*) AS n, round(sum(v), 6) AS total, round(sum(v * v), 6) AS squares, 10 AS width, CASE WHEN class >= 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS hot
  FROM cells GROUP BY ALL""")
def _(t: Tables):
    """All 64 values of all pairs, summed per class that the one-hot label names."""
    pairs = readers.feature_label_pairs(t.vectors(), "x", "label", 10)
    hot = F.aggregate("label", F.lit(0.0), lambda a, v: a + v)
    cells = pairs.select((F.array_position("label", F.lit(1.0)) - 1).cast("int").alias("class"), F.size("label").alias("width"), hot.alias("hot"), F.posexplode("features").alias("j", "v"))
    return cells.groupBy("class", "j", "width", "hot").agg(F.count("*").alias("n"), F.round(F.sum("v"), 6).alias("total"), F.round(F.sum(F.col("v") * F.col("v")), 6).alias("squares"))


@query("a18_result_messages", f"""WITH numbered AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS n FROM events)
  SELECT 'MIDAS-AD-msg-' || CAST(n AS VARCHAR) AS key, {FLOW_CSV} || ',MIDAS,"[]",' || printf('%.6f', value) || ','
    || CASE WHEN value > 100 THEN '1' ELSE '0' END AS value, CAST(3 AS INTEGER) AS partition FROM numbered""")
def _(t: Tables):
    messages = t.messages(48).join(t("events").select(F.col("event_id").alias("id"), F.col("value").alias("score")), "id")
    payload = writers.result_csv(F.col("value"), "MIDAS", None, F.col("score"), F.col("score") > 100)
    return writers.keyed_messages(messages.select("id", payload.alias("payload")), "payload", "id", "MIDAS-AD-msg-", 3)


@query("a19_json_alerts", """SELECT event_id AS id, '{"in_data":{"source":' || CAST(user_id AS VARCHAR) || ',"destination":'
  || CAST(event_id % 50 AS VARCHAR) || '},"method":"MIDAS-F(slot: 1min, score thr: 7062069)","score":'
  || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || '}' AS value FROM events""")
def _(t: Tables):
    fields = F.struct(F.col("user_id").alias("source"), (F.col("event_id") % 50).alias("destination"))
    alert = writers.alert_json(fields, writers.method_label("1min", 7062069), F.floor("value").cast("bigint"))
    return t("events").select(F.col("event_id").alias("id"), alert.alias("value"))


@query("a21_alert_read_back", """SELECT event_id AS id, user_id AS source, 'MIDAS' AS method, value AS score FROM events""")
def _(t: Tables):
    alert = writers.alert_json(F.struct(F.col("user_id").alias("source")), "MIDAS", F.col("value"))
    sent = t("events").select(F.col("event_id").alias("id"), alert.alias("value"))
    parsed = F.from_json("value", "in_data struct<source: bigint>, method string, score double")
    back = sent.select("id", parsed.alias("a"))
    return back.select("id", F.col("a.in_data.source").alias("source"), F.col("a.method").alias("method"), F.col("a.score").alias("score"))


@query("b13_width_check", """SELECT event_id AS id, CASE event_id % 3 WHEN 0 THEN 48 WHEN 1 THEN 71 ELSE 5 END AS width,
  event_id % 3 < 2 AS accepted FROM events""")
def _(t: Tables):
    wide = t.messages(71).select("id", F.col("value").alias("wide"))
    value = F.when(F.col("id") % 3 == 0, F.col("value")).when(F.col("id") % 3 == 1, F.col("wide")).otherwise("a,b,c,d,e")
    mixed = t.messages(48).join(wide, "id").select("id", value.alias("value"))
    good, bad = parse.split_by_width(mixed)
    width = parse.message_width(F.col("value")).alias("width")
    return good.select("id", width, F.lit(True).alias("accepted")).union(bad.select("id", width, F.lit(False).alias("accepted")))


@query("b14_module_position", """SELECT event_id AS id, CASE event_id % 3 WHEN 0 THEN 48 WHEN 1 THEN 71 ELSE -1 END AS position,
  CASE event_id % 3 WHEN 0 THEN 'MIDAS' WHEN 1 THEN 'ZEEKFLOW' END AS module FROM events""")
def _(t: Tables):
    wide = t.messages(71).select("id", F.concat("value", F.lit(',ZEEKFLOW,"[]",1.5,1')).alias("wide"))
    value = (
        F.when(F.col("id") % 3 == 0, F.concat("value", F.lit(',MIDAS,"[]",1.5,1')))
        .when(F.col("id") % 3 == 1, F.col("wide"))
        .otherwise(F.concat("value", F.lit(',OTHER,"[]",1.5,1')))
    )
    mixed = t.messages(48).join(wide, "id").select("id", value.alias("value"))
    at = parse.module_position(F.col("value"))
    return mixed.select("id", F.coalesce(at, F.lit(-1)).alias("position"), F.get(F.split("value", ","), at).alias("module"))


@query("b18_tenant_check", """SELECT event_id AS id, event_id % 4 IN (0, 1) AS ok FROM events""")
def _(t: Tables):
    uuid = F.lit("-0a1b-2C3d-4e5f-0123456789ab")
    eight = F.lpad(F.hex(F.col("event_id")), 8, "0")
    tenant = (
        F.when(F.col("event_id") % 4 == 0, F.concat(eight, uuid)).when(F.col("event_id") % 4 == 1, "ANY_TENANT")
        .when(F.col("event_id") % 4 == 2, F.concat(eight, F.lit("x"), uuid)).otherwise("")
    )
    return t("events").select(F.col("event_id").alias("id"), clean.is_tenant(tenant).alias("ok"))


_PAYLOADS = f"""payloads AS (SELECT event_id AS id,
    CASE event_id % 3 WHEN 0 THEN 'IFOREST' WHEN 1 THEN 'MIDAS' ELSE 'AE' END AS module, value AS score,
    value > 100 AS is_anomalous, CASE event_id % 3 WHEN 0 THEN repeat('1.5,', 32) || '2' WHEN 1 THEN '' ELSE '7,8' END AS features
    FROM events)"""


@query("c17_result_payload", f"""WITH {_PAYLOADS} SELECT id, module, features, score, is_anomalous,
  '10.1.0.' || CAST(id % 50 AS VARCHAR) AS da FROM payloads WHERE module <> 'AE'""")
def _(t: Tables):
    scores = t("events").select(F.col("event_id").alias("id"), F.col("value").alias("score"))
    module = F.when(F.col("id") % 3 == 0, "IFOREST").when(F.col("id") % 3 == 1, "MIDAS").otherwise("AE")
    features = F.when(F.col("id") % 3 == 0, F.concat(F.repeat(F.lit("1.5,"), 32), F.lit("2"))).when(
        F.col("id") % 3 == 1, "").otherwise("7,8")
    value = F.concat_ws(",", "value", module, F.concat(F.lit('"['), features, F.lit(']"')), F.col("score").cast("string"),
                        F.when(F.col("score") > 100, "1").otherwise("0"))
    sent = t.messages(48).join(scores, "id").select("id", value.alias("value"))
    parsed = parse.parse_results(sent, keep=["id"])
    return parsed.select("id", "module", "features", "score", "is_anomalous", F.col("flow")[4].alias("da"))


@query("c11_flow_key", """SELECT l_orderkey, l_linenumber, l_partkey, sha1(CAST(l_orderkey AS VARCHAR) || CAST(l_partkey AS VARCHAR)
  || l_returnflag) AS key, substr(sha1(CAST(l_orderkey AS VARCHAR) || CAST(l_partkey AS VARCHAR) || l_returnflag), 1, 8) AS short_key
  FROM lineitem""")
def _(t: Tables):
    fields = [F.col("l_orderkey"), F.col("l_partkey"), F.col("l_returnflag")]
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", S.sha1_key(fields).alias("key"),
                                S.sha1_key(fields, 8).alias("short_key"))


@query("e02_high_water_offset", """SELECT CAST(user_id % 25 AS INTEGER) AS partition, max(event_id) AS high_water FROM events GROUP BY 1""")
def _(t: Tables):
    records = t("events").select((F.col("user_id") % 25).cast("int").alias("partition"), F.col("event_id").alias("offset"))
    return records.groupBy("partition").agg(F.max("offset").alias("high_water"))


@query("a02_since_offset", f"""WITH {flow_sql()} SELECT id, sa FROM flow WHERE id >= 100""")
def _(t: Tables):
    records = t.flow().withColumn("offset", F.col("id"))
    return readers.since_offset(records, 100).select("id", "sa")
