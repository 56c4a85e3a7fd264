import numpy as np
from pyspark.sql import functions as F

from flowguard.operators import clean, joins
from flowguard.plans.netflow_autoencoder import NetflowAutoencoder
from flowguard.plans.suite.base import Tables
from flowguard.plans import edge_scores
from flowguard.plans.two_view import TwoView
from flowguard.sources.parse import parse_flow, parse_results
from flowguard.sources.writers import OrdinalSink
from flowguard.streaming.batches import VersionedTable, write_each

FOLDER = "/root/testdata/sf0.001"


def scans(df, table):
    """Scans of a source table in the plan that ran; stored intermediate tables do not count."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    return sum("FileScan" in line and f"{table}.parquet" in line for line in final.splitlines())


def test_ordinals_go_on_from_batch_to_batch(spark, tmp_path):
    path = str(tmp_path)
    sink = OrdinalSink(VersionedTable(spark, f"{path}/marks"), write_each(f"{path}/out"), "value", "id", "m-")
    parts = [spark.range(0, 5), spark.range(5, 5), spark.range(5, 12)]
    for batch, part in enumerate(parts):
        rows = part.withColumn("value", F.col("id").cast("string"))
        sink(rows, batch)
        sink(rows, batch)  # a repeated batch gets the numbers it had
    got = {r["key"]: r["value"] for r in spark.read.parquet(f"{path}/out").collect()}
    assert got == {f"m-{i}": str(i) for i in range(12)}


def test_two_view_saves_scores_and_names_what_it_rejects(spark, tmp_path):
    flows = parse_flow(Tables(spark, FOLDER).messages(71), 71, keep=["id"])
    flows = flows.join(Tables(spark, FOLDER).messages(71).select("id", "value"), "id")
    flows = flows.withColumn("zeek", F.when(F.col("id") % 10 == 0, F.repeat(F.lit("ShAD"), 10)).otherwise(F.col("zeek")))
    model = TwoView.fit(flows, ["...APRS.", "........"], hidden=(4,), epochs=1, workers=2)
    model.save(str(tmp_path / "view"))
    again = TwoView.load(str(tmp_path / "view"))
    columns = ["id", F.round("flow_error", 6).alias("a"), F.round("history_error", 6).alias("b")]
    want = sorted(map(tuple, model.score(flows).select(*columns).collect()))
    assert sorted(map(tuple, again.score(flows).select(*columns).collect())) == want
    rejected = {r["id"]: r["missing"] for r in model.rejects(flows).collect()}
    assert rejected and all(i % 10 == 0 and m == ["history"] for i, m in rejected.items())
    assert not rejected.keys() & {w[0] for w in want}
    results = parse_results(model.messages(flows), keep=["id"])
    assert {r["module"] for r in results.select("module").collect()} == {"ZEEKFLOW"} and results.count() == len(want)


def test_autoencoder_saves(spark, tmp_path):
    flows = parse_flow(Tables(spark, FOLDER).messages(48), 48, keep=["id"])
    model = NetflowAutoencoder.fit(flows, hidden=(4,), epochs=1, workers=2)
    model.save(str(tmp_path / "net"))
    again = NetflowAutoencoder.load(str(tmp_path / "net"))
    for a, b in zip(model.net.weights, again.net.weights):
        np.testing.assert_array_equal(a, b)


def test_joins_read_each_side_once(spark):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    key = F.col("o_custkey").cast("string")
    flows = orders.select(F.col("o_orderkey").alias("id"), *[key.alias(k) for k in joins.CONNECTION_KEYS])
    connections = orders.select(*[key.alias(k) for k in joins.CONNECTION_KEYS.values()], F.col("o_orderkey").alias("ts"))
    assert scans(joins.merge_connections(flows, connections), "orders") == 2
    assert scans(joins.unmatched(flows, connections.withColumnsRenamed({v: k for k, v in joins.CONNECTION_KEYS.items()}), list(joins.CONNECTION_KEYS), "id"), "orders") == 2


def test_address_codes_read_the_table_at_most_twice(spark):
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    flows = events.select(F.col("event_id").alias("id"), F.concat(F.lit("h"), F.col("user_id").cast("string")).alias("sa"), F.lit("10.0.0.1").alias("da"))
    coded = clean.encode_addresses(flows)
    assert scans(coded, "events") <= 2 and coded.filter("sa IS NULL OR da IS NULL").count() == 0


def test_edge_and_autoencoder_rejects(spark):
    messages = Tables(spark, FOLDER).messages(48).select("id", "value").filter("id < 40")
    broken = F.when(F.col("id") == 1, F.lit("a,b,c")).when(F.col("id") == 2, F.regexp_replace("value", "^[^,]*", "no time")).when(
        F.col("id") == 3, F.regexp_replace("value", "10\\.1\\.0\\.\\d+", "nowhere")).when(F.col("id") == 4, F.lit(None)).otherwise(F.col("value"))
    odd = messages.withColumn("value", broken)
    got = {r["id"]: r["reason"] for r in edge_scores.rejects(odd).collect()}
    kept = {r["id"] for r in edge_scores.edges_of(odd).collect()}
    assert got == {1: "width", 2: "time", 3: "address", 4: "width"} and kept == set(range(40)) - set(got)
    flows = parse_flow(Tables(spark, FOLDER).messages(48), 48, keep=["id"])
    flows = flows.withColumn("td", F.when(F.col("id") % 50 != 0, F.col("td")))
    model = NetflowAutoencoder.fit(flows, hidden=(4,), epochs=1, workers=2)
    scored = {r["id"] for r in model.score(flows).select("id").collect()}
    rejected = {r["id"] for r in model.rejects(flows).collect()}
    assert rejected and not rejected & scored


def test_two_view_reads_every_flow_once(spark):
    flows = parse_flow(Tables(spark, FOLDER).messages(71), 71, keep=["id"])
    n, reads = flows.count(), spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        reads.add(1)
        return text

    flows = flows.withColumn("ts", counted("ts"))
    model = TwoView.fit(flows, ["...APRS.", "........"], hidden=(4,), epochs=2, workers=2)
    assert reads.value == n
    assert model.score(flows).filter("combined_error IS NOT NULL").count() == n and reads.value == 2 * n
