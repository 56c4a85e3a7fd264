"""Queries that run as streams over the event table and read back what the stream wrote."""

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.operators.windows import trailing_means
from flowguard.plans.suite.base import MODULE_OF, RESULTS_SQL, Tables, flow_sql, query
from flowguard.session import ensure_checkpoint_dir
from flowguard.streaming import batches as B
from flowguard.streaming.correlator import correlate_stream
from flowguard.streaming.cutoffs import CutoffSketches
from flowguard.streaming.rings import last_rows_stream


class StreamedTables(Tables):
    """The same views, with tables read as file streams: a table may be one file or a folder of them."""

    def __call__(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        stream = self.spark.readStream.schema(self.spark.read.parquet(path).schema)
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        if target.getFileSystem(self.spark._jsc.hadoopConfiguration()).getFileStatus(target).isDirectory():
            return stream.parquet(path)
        return stream.option("pathGlobFilter", f"{name}.parquet").parquet(self.folder)


class Arrivals(Tables):
    """Views over ``events`` as a stream that arrives in the order of time, a folder of files at a time.

    ``feed`` writes a part with Spark's own partitions and runs the stream until it is used up, then the next one; each run is
    a restart from the last run's progress. Results may not depend on ``parts``.
    """

    def __init__(self, t: Tables, path: str, parts: int = 4):
        super().__init__(t.spark, t.folder)
        self.path, events = path, t("events")
        self.schema = events.schema
        hour = F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 3600)
        times = [r[0] for r in events.select(hour.alias("h")).distinct().orderBy("h").collect()]  # hours
        edges = [times[len(times) * k // parts] for k in range(parts)] + [None] if times else []
        self.parts = [events.filter(hour >= a) if b is None else events.filter((hour >= a) & (hour < b)) for a, b in zip(edges, edges[1:])]

    def __call__(self, name: str) -> DataFrame:
        return self.spark.readStream.schema(self.schema).parquet(f"{self.path}/arrivals")

    def feed(self, build, handle) -> None:
        _feed(self.parts, f"{self.path}/arrivals", lambda: build(self), handle, self.path)


def _feed(parts: list[DataFrame], folder: str, build, handle, path: str, partitions: int | None = None) -> None:
    """Append each part to the folder and run the stream over what is new."""
    for part in parts:
        part.write.mode("append").parquet(folder)
        B.run_batches(build(), handle, f"{path}/progress", partitions=partitions).awaitTermination()


def _scratch(t: Tables) -> str:
    ensure_checkpoint_dir(t.spark)
    return f"{t.spark.sparkContext._jsc.sc().getCheckpointDir().get()}/stream-{uuid.uuid4().hex}"


def _run(t: Tables, stream: DataFrame, handle, path: str) -> None:
    B.run_batches(stream, handle, f"{path}/progress").awaitTermination()


@query("a03_replay_from_earliest", "SELECT event_id AS id, user_id, value FROM events")
def _(t: Tables):
    path = _scratch(t)
    stream = StreamedTables(t.spark, t.folder)("events").select(F.col("event_id").alias("id"), "user_id", "value")
    _run(t, stream, B.write_each(f"{path}/out"), path)
    return t.spark.read.parquet(f"{path}/out").drop("batch")


@query("t02_look_back_windows", f"""WITH {flow_sql(60)} SELECT id, round(avg(td) OVER (ORDER BY sec RANGE BETWEEN 600 PRECEDING AND CURRENT ROW), 9)
  AS td_600_mean FROM flow""")
def _(t: Tables):
    path = _scratch(t)

    def handle(rows: DataFrame, batch_id: int) -> None:
        out = trailing_means(rows, ["td"], (600,)).filter("not is_context")
        B.write_each(f"{path}/out")(out.select("id", F.round("td_600_mean", 9).alias("td_600_mean")), batch_id)

    Arrivals(t, path).feed(lambda a: a.flow(60).select("id", "sec", "td"), B.LookBack(t.spark, f"{path}/context", 600, handle))
    return t.spark.read.parquet(f"{path}/out").drop("batch")


@query("t04_edge_stream", f"""WITH {flow_sql()}, first AS (SELECT da % 3 AS tenant, arg_min(sec, id) AS origin FROM flow GROUP BY 1)
  SELECT f.id AS seq, f.da % 3 AS tenant, f.sa AS src, f.da AS dst,
    greatest(CAST(floor((f.sec - 0.0 - o.origin) / 3600) AS BIGINT) + 1, 1) AS slot, true AS same_as_bounded
  FROM flow f JOIN first o ON o.tenant = f.da % 3""")
def _(t: Tables):
    """Four micro-batches, one sketch per tenant: every score equals that of the bounded scorer over all rows at once."""
    from flowguard.operators import edges as E

    path = _scratch(t)

    def edges(tables: Tables) -> DataFrame:
        return tables.flow().select(
            F.col("id").alias("seq"), (F.col("da") % 3).alias("tenant"), F.col("sa").alias("src"), F.col("da").alias("dst"), F.col("sec").alias("epoch"))

    Arrivals(t, path).feed(edges, B.EdgeStream(t.spark, f"{path}/state", B.write_each(f"{path}/out"), 3600, keys=["tenant"]))
    streamed = t.spark.read.parquet(f"{path}/out").select("seq", "tenant", "src", "dst", "slot", "score")
    bounded = E.filtered_burst(E.with_slots(edges(t), "epoch", 3600, "seq", keys=["tenant"]), "seq", keys=["tenant"]).select("seq", F.col("score").alias("_want"))
    same = F.abs(F.col("score") - F.col("_want")) <= 1e-6 * F.greatest(F.lit(1.0), F.abs("_want"))
    return streamed.join(bounded, "seq").select("seq", "tenant", "src", "dst", "slot", same.alias("same_as_bounded"))


@query("t10_learned_cutoffs", """SELECT user_id % 5 AS tenant, count(*) AS n, true AS within_error, true AS judged_by_the_past FROM events GROUP BY 1""")
def _(t: Tables):
    """Cutoffs per tenant learned over four micro-batches: each within the sketches' rank error of the exact quantile of the
    scores before its batch, and every verdict is that of its batch's cutoff."""
    path, q, error = _scratch(t), 0.95, 0.005
    sketches = CutoffSketches(t.spark, f"{path}/sketches", ["tenant"], q=q, error=error)
    kept = B.VersionedTable(t.spark, f"{path}/cutoffs")

    def handle(rows: DataFrame, batch_id: int) -> None:
        B.write_each(f"{path}/out")(sketches.judge(rows, batch_id, F.lit(10)), batch_id)
        known = sketches.cutoffs(batch_id)
        kept.write(batch_id, known if known is not None else rows.select("tenant", F.lit(10).cast("bigint").alias("cutoff"), F.lit(0).cast("bigint").alias("n")).distinct())
        sketches.update(rows, batch_id)

    Arrivals(t, path).feed(lambda a: a("events").select((F.col("user_id") % 5).alias("tenant"), F.col("value").alias("score")), handle)
    judged, cutoffs = (t.spark.read.parquet(f"{path}/{x}") for x in ("out", "cutoffs"))
    said = judged.join(cutoffs.select("tenant", "batch", F.col("cutoff").alias("want")), ["tenant", "batch"])
    verdicts = said.groupBy("tenant").agg(F.count("*").alias("n"), F.min((F.col("cutoff") == F.col("want")) & (F.col("is_anomalous") == (F.col("score") > F.col("want")))).alias("judged_by_the_past"))
    # The share of earlier scores up to the cutoff: its floor lies within one unit below the sketch's quantile.
    past = cutoffs.filter("n > 0").alias("c").join(judged.select("tenant", F.col("batch").alias("b"), "score"), "tenant").filter("b < batch")
    shares = past.groupBy("tenant", "batch").agg(F.avg((F.col("score") < F.col("cutoff")).cast("double")).alias("below"), F.avg((F.col("score") <= F.col("cutoff") + 1).cast("double")).alias("upto"),
                                                 (F.count("*") == F.max("n")).alias("all"))
    near = shares.groupBy("tenant").agg(F.min(F.col("all") & (F.col("below") <= q + error) & (F.col("upto") >= q - error)).alias("within_error"))
    return verdicts.join(near, "tenant").select("tenant", "n", "within_error", "judged_by_the_past")


@query("g04_ring_of_last_rows", """SELECT tenant, id, td FROM (SELECT user_id % 4 AS tenant, event_id AS id, value AS td,
  row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id DESC) AS r FROM events) WHERE r <= 50""")
def _(t: Tables):
    """The last 50 rows of every tenant as stream state after four micro-batches: of each tenant's rings the newest."""
    path = _scratch(t)
    rings = lambda a: last_rows_stream(a.flow().select((F.col("sa") % 4).alias("tenant"), "id", "td"), 50, "tenant", "id")
    Arrivals(t, path).feed(rings, B.write_each(f"{path}/out"))
    out = t.spark.read.parquet(f"{path}/out")
    newest = out.groupBy("tenant").agg(F.max("batch").alias("batch"))
    return out.join(newest, ["tenant", "batch"]).select("tenant", "id", "td")


_DAY_MS = 86_400_000


def correlated(t: Tables, parts: int, path: str, repeats: int = 1, shift_days: int = 1) -> DataFrame:
    """Flows fused by event time from ``parts`` releases of the results, each sent ``repeats`` times, some days apart.

    A row of no detector three days behind everything lets the watermark close what is open; the result is written batch by
    batch and read back. Nothing waits for a clock.
    """
    module = F.element_at(F.create_map(*[F.lit(x) for pair in MODULE_OF.items() for x in pair]), F.col("event_type"))
    at = F.col("ts").cast("timestamp")
    once = t("events").select(
        F.concat(F.col("user_id").cast("string"), F.lit("|"), F.date_format("ts", "yyyy-MM-dd")).alias("key"), module.alias("module"), F.col("value").alias("score"),
        (F.col("value") > 100).alias("is_anomalous"), F.concat(F.lit("f"), F.col("event_id").cast("string")).alias("features"), at.alias("at"))
    sent = reduce(DataFrame.unionAll, [once.withColumn("at", F.expr(f"at + INTERVAL {k * shift_days} DAYS")) for k in range(repeats)])
    sent = sent.withColumn("arrival", F.unix_micros("at"))
    low, high = sent.agg(F.unix_micros(F.min("at")).alias("a"), F.unix_micros(F.max("at")).alias("b")).first()
    place = F.least(F.floor((F.col("arrival") - (low or 0)) / max(1, ((high or 0) - (low or 0)) // parts + 1)), F.lit(parts - 1))
    released = [sent.filter(place == k) for k in range(parts)]
    end = sent.limit(0).unionByName(sent.agg(F.max("at").alias("at")).select(
        F.lit("end").alias("key"), F.lit("none").alias("module"), F.lit(0.0).alias("score"), F.lit(False).alias("is_anomalous"), F.lit("").alias("features"),
        F.expr("at + INTERVAL 30 DAYS").alias("at"), F.lit(0).cast("long").alias("arrival")))

    def stream() -> DataFrame:
        rows = t.spark.readStream.schema(sent.schema).parquet(f"{path}/in")
        return correlate_stream(rows, time="at", rule="MIDAS_IFOREST", late="drop", only_anomalous=False, timeout_ms=2 * _DAY_MS)

    _feed([*released, end], f"{path}/in", stream, B.write_each(f"{path}/out"), path, B.state_partitions(t.spark))
    return t.spark.read.parquet(f"{path}/out").drop("batch")


@query("t05_correlated_stream", f"""WITH {RESULTS_SQL}, r AS (SELECT results.*, epoch_us(ts) AS us FROM results JOIN events ON event_id = arrival)
  SELECT key, arg_min(score, us) FILTER (WHERE module = 'MIDAS') AS midas_score, arg_min(score, us) FILTER (WHERE module = 'IFOREST') AS iforest_score, min(us) AS first_arrival,
  CASE WHEN count(*) FILTER (WHERE module = 'MIDAS') > 0 AND count(*) FILTER (WHERE module = 'IFOREST') > 0 THEN 'complete' ELSE 'timeout' END AS reason
  FROM r GROUP BY key""")
def _(t: Tables):
    """Every flow ends: by completion, or by its time-out in event time."""
    return correlated(t, 4, _scratch(t)).select("key", F.col("midas.score").alias("midas_score"), F.col("iforest.score").alias("iforest_score"), "first_arrival", "reason")


@query("t07_repeat_suppression", "SELECT event_id AS id FROM events")
def _(t: Tables):
    """Every event is sent three times, twice in one micro-batch and once in the next: one of each comes out."""
    path = _scratch(t)
    sent = t("events").select(F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("timestamp"))
    stream = lambda: B.without_repeats(t.spark.readStream.schema(sent.schema).parquet(f"{path}/in"), ["id"], within="60 days")
    _feed([sent.union(sent), sent], f"{path}/in", stream, B.write_each(f"{path}/out"), path)
    return t.spark.read.parquet(f"{path}/out").select("id")


@query("t08_late_results", f"""WITH {RESULTS_SQL} SELECT key, count(DISTINCT module) FILTER (WHERE module IN ('MIDAS', 'IFOREST')) = 2 AS complete FROM results GROUP BY key""")
def _(t: Tables):
    """All results come again a day later: closed flows stay closed for their time-out, so no flow is sent twice."""
    return correlated(t, 4, _scratch(t), repeats=2).select("key", (F.col("reason") == "complete").alias("complete"))
