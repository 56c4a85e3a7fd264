"""Micro-batch jobs with versioned state tables.

State that spans batches lives in one folder per batch id. A batch reads the version before it
and writes its own, so a batch that is run again after a failure gives the same result.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowguard.functions.scalar import slot_number
from flowguard.operators import edges as E
from flowguard.session import checkpointed, temporary_tables
from flowguard.sources.message_log import Log, register

Handle = Callable[[DataFrame, int], None]


PARTITIONS = "spark.sql.shuffle.partitions"


def state_partitions(spark: SparkSession) -> int:
    """Partitions for streams that do little besides keeping state: one per core, but not more than the session's shuffles have.

    Every partition opens, checks and stores its state in every batch, even where it has no rows.
    """
    return min(int(spark.conf.get(PARTITIONS)), max(8, spark.sparkContext.defaultParallelism))


def run_batches(stream: DataFrame, handle: Handle, checkpoint: str, every: str | None = None, partitions: int | None = None) -> StreamingQuery:
    """Feed micro-batches to ``handle``; without an interval, process what is there and stop.

    Intermediate tables of a batch are deleted when its handler returns, so handlers write what they are for. A stream starts
    with ``partitions`` partitions of state, if given, and keeps their number with the checkpoint.
    """

    def handled(frame: DataFrame, batch_id: int) -> None:
        with temporary_tables(frame.sparkSession):
            handle(frame, batch_id)

    writer = stream.writeStream.foreachBatch(handled).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    conf = stream.sparkSession.conf
    usual = conf.get(PARTITIONS)
    try:
        conf.set(PARTITIONS, str(partitions or usual))
        return writer.start()  # the query takes a copy of the settings
    finally:
        conf.set(PARTITIONS, usual)


class VersionedTable:
    """Parquet folder per batch id."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def has(self, batch: int) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch={batch}/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def before(self, batch: int) -> DataFrame | None:
        """The version a batch builds on: that of the batch before it."""
        return self.spark.read.parquet(f"{self.path}/batch={batch - 1}") if batch and self.has(batch - 1) else None

    def write(self, batch: int, frame: DataFrame) -> None:
        frame.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def drop_before(self, batch: int, keep: int = 2) -> None:
        """Remove versions no restart can ask for any more."""
        old = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch={batch - keep}")
        old.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(old, True)

    def all(self) -> DataFrame:
        return self.spark.read.parquet(self.path)


class LookBack:
    """Gives every batch the rows of the last ``seconds`` before it as context.

    ``handle(rows, batch)`` gets the new rows with ``is_context`` false and the kept ones with
    ``is_context`` true, so that windows reach back across batch borders.
    """

    def __init__(self, spark: SparkSession, path: str, seconds: int, handle: Handle, sec: str = "sec"):
        self.table = VersionedTable(spark, path)
        self.seconds, self.handle, self.sec = seconds, handle, sec

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("is_context", F.lit(False))
        kept = self.table.before(batch_id)
        if kept is not None:
            rows = rows.unionByName(kept.withColumn("is_context", F.lit(True)).select(*rows.columns))
        self.handle(rows, batch_id)
        newest = rows.agg(F.max(self.sec).alias("_newest"))
        recent = rows.join(F.broadcast(newest)).filter(F.col(self.sec) >= F.col("_newest") - self.seconds)
        self.table.write(batch_id, recent.drop("_newest", "is_context"))
        self.table.drop_before(batch_id)


class EdgeStream:
    """Filtering edge scorer over micro-batches, one sketch per key.

    A batch is scored by the same distributed operator as bounded data, starting from the
    sketch the previous batch left behind.
    """

    def __init__(
        self, spark: SparkSession, path: str, out: Handle, slot_len: int, order: str = "seq", epoch: str = "epoch",
        keys: list[str] = (), cutoffs=None, fallback: int = E.FALLBACK_CUTOFF, **scorer,
    ):
        """``cutoffs`` is a table of stored cutoffs (``store_cutoff``) or ``CutoffSketches`` that learn from every batch; with
        the latter, ``fallback`` holds until a key has scores."""
        self.state, self.origin = VersionedTable(spark, f"{path}/sketch"), VersionedTable(spark, f"{path}/origin")
        self.out, self.slot_len, self.order, self.epoch = out, slot_len, order, epoch
        self.keys, self.cutoffs, self.fallback, self.scorer = list(keys), cutoffs, fallback, scorer

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, keys = batch.sparkSession, self.keys
        first = batch.groupBy(*keys).agg(F.min_by(self.epoch, self.order).alias("origin"))
        known = self.origin.before(batch_id)
        if known is not None:
            both = known.withColumn("_age", F.lit(0)).unionByName(first.withColumn("_age", F.lit(1)))
            first = both.groupBy(*keys).agg(F.min_by("origin", "_age").alias("origin"))
        self.origin.write(batch_id, first)
        origin = spark.read.parquet(f"{self.origin.path}/batch={batch_id}")
        slotted = batch.join(origin, keys) if keys else batch.join(F.broadcast(origin))
        slotted = slotted.withColumn("slot", slot_number(F.col(self.epoch), F.col("origin"), self.slot_len))
        # Rows dated before the first event fall into the first slot.
        slotted = slotted.withColumn("slot", F.greatest("slot", F.lit(1).cast("bigint"))).drop("origin")
        scored, after = E.filtered_burst_step(
            slotted, self.state.before(batch_id), self.order, keys, **self.scorer
        )
        learns = hasattr(self.cutoffs, "judge")
        if learns:
            scored = self.cutoffs.judge(checkpointed(scored), batch_id, F.lit(self.fallback))
        elif self.cutoffs is not None:
            scored = scored.join(F.broadcast(current_cutoff(self.cutoffs))).withColumn(
                "is_anomalous", F.col("score") > F.col("cutoff")
            )
        self.out(scored, batch_id)
        if learns:
            self.cutoffs.update(scored, batch_id)
        self.state.write(batch_id, after)
        for table in (self.state, self.origin):
            table.drop_before(batch_id)


def current_cutoff(cutoffs: DataFrame) -> DataFrame:
    """The latest cutoff of an append-only table with (cutoff, set_at); one row."""
    return cutoffs.agg(F.max_by("cutoff", "set_at").alias("cutoff"))


def store_cutoff(cutoff: DataFrame, path: str) -> None:
    """Append a retrained cutoff; streams that read the table pick it up with their next batch."""
    cutoff.select(F.col("cutoff").cast("bigint").alias("cutoff"), F.current_timestamp().alias("set_at")).write.mode(
        "append"
    ).parquet(path)


def write_each(path: str, format: str = "parquet") -> Handle:
    """Idempotent file output: a batch id owns its folder."""

    def handle(frame: DataFrame, batch_id: int) -> None:
        frame.write.mode("overwrite").format(format).save(f"{path}/batch={batch_id}")

    return handle


def high_water(records: DataFrame) -> str:
    """Offsets reached per topic and partition, in the form readers take as starting offsets."""
    rows = records.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next")).collect()
    out: dict[str, dict[str, int]] = {}
    for r in rows:
        out.setdefault(r["topic"], {})[str(r["partition"])] = r["next"]
    return json.dumps(out)


def without_repeats(stream: DataFrame, columns: list[str], ts: str = "timestamp", within: str = "10 minutes") -> DataFrame:
    """Suppress rows already emitted within the watermark."""
    return stream.withWatermark(ts, within).dropDuplicatesWithinWatermark(columns)


def score_flows(model, handle_out: Handle, approximate: bool = False) -> Handle:
    """Batch handler for :class:`LookBack`: window features over context and news, verdicts for news."""
    return scored_news(model, handle_out, **({"approximate": True} if approximate else {}))


def scored_news(model, handle_out: Handle, **options) -> Handle:
    """Batch handler for :class:`LookBack` and any model with ``score(rows, **options)`` that keeps ``id``."""

    def handle(rows: DataFrame, batch_id: int) -> None:
        rows = checkpointed(rows)
        scored = model.score(rows.drop("is_context"), **options)
        fresh = rows.filter("not is_context").select("id")
        handle_out(scored.join(fresh, "id", "left_semi"), batch_id)

    return handle


class LogSink:
    """Micro-batch output to a message log (``sources/message_log.py``): a batch id is accepted once.

    ``message`` turns scored rows into (key, value[, partition, topic, timestamp]); by default the value is the row as JSON
    without its vectors.
    """

    def __init__(self, spark: SparkSession, path: str, message: Callable[[DataFrame], DataFrame] | None = None, topic: str = "verdicts"):
        register(spark)
        self.log, self.topic = Log(path), topic
        self.message = message or as_json

    def has(self, batch_id: int) -> bool:
        return self.log.has(str(batch_id))

    def __call__(self, frame: DataFrame, batch_id: int) -> None:
        if not self.has(batch_id):
            self.message(frame).write.format("message_log").options(batch=batch_id, topic=self.topic).mode("append").save(self.log.path)


def as_json(scored: DataFrame) -> DataFrame:
    """(key, value): the id, and all columns but vectors and arrays as one JSON object."""
    plain = [f.name for f in scored.schema.fields if f.dataType.typeName() not in ("vector", "vectorudt", "array")]
    return scored.select(F.col("id").cast("string").cast("binary").alias("key"), F.to_json(F.struct(*plain)).cast("binary").alias("value"))


def detector_job(spark: SparkSession, model, state: str, sink: LogSink, seconds: int = 600, sec: str = "sec", **options) -> Handle:
    """One exactly-once handler for every detector: context, scores, sink, state, in this order.

    A batch the sink has taken is not scored again; if the job died before its context was stored, that is all that is left to
    do when the batch comes back. ``model`` has ``score(rows, **options)`` with an ``id``; ``seconds`` is its longest window.
    """
    score = scored_news(model, sink, **options)

    def handle(rows: DataFrame, batch_id: int) -> None:
        if not sink.has(batch_id):
            score(rows, batch_id)

    return LookBack(spark, state, seconds, handle, sec)
