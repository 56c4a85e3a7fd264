"""Detector result messages to fused messages: parsing, flow keys, fusing, the propagation rule and the wire format."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.functions.scalar import sha1_key
from flowguard.operators import correlate as C
from flowguard.schema import NETFLOW12, NETFLOW48
from flowguard.sources.parse import module_position, parse_results, shared_flow_fields
from flowguard.sources.writers import keyed_messages
from flowguard.streaming.correlator import correlate_stream

PREFIX = "AD-aggr-message-"


def keyed_results(messages: DataFrame, order: str = "id", value: str = "value", keep: list[str] = ()) -> DataFrame:
    """(key, module, score, is_anomalous, features, arrival, flow) and ``keep`` of the messages that are detector results."""
    parsed = parse_results(messages, value, keep=[order, *keep])
    fields = [F.get("flow", F.lit(NETFLOW48.index(name))).alias(name) for name in NETFLOW12]
    return parsed.select(
        sha1_key(shared_flow_fields(F.col("flow"))).alias("key"), "module", "score", "is_anomalous", "features",
        F.col(order).cast("long").alias("arrival"), F.struct(*fields).alias("flow"), *keep,
    )


def rejects(messages: DataFrame, order: str = "id", value: str = "value") -> DataFrame:
    """Messages that no flow is fused from: no known detector, or a payload that does not fit it."""
    good = parse_results(messages, value, keep=[order]).select(order)
    bad = messages.join(good, order, "left_anti")
    return bad.withColumn("reason", F.when(module_position(F.col(value)).isNull(), "no detector").otherwise("bad payload"))


def aggregate(messages: DataFrame, need_features: bool = False, order: str = "id", first_ordinal: int = 0) -> DataFrame:
    """Fused messages (key, value), numbered from ``first_ordinal`` in the order in which flows were first seen.

    Of a flow's repeated results the first counts; flows that no detector flagged are left out.
    """
    fused = C.fuse(keyed_results(messages, order), flow=["flow"]).filter(C.shall_propagate(need_features))
    line = C.fused_csv([F.col(f"flow.flow.{name}") for name in NETFLOW12])
    return keyed_messages(fused.select("first_arrival", line.alias("line")), "line", "first_arrival", PREFIX, first=first_ordinal)


_FLOW = ", ".join(f"{name} string" for name in NETFLOW12)


def aggregate_stream(messages: DataFrame, order: str = "id", time: str | None = None, **options) -> DataFrame:
    """Fused rows of a message stream, by completion or time-out (``correlate_stream``), with the flow's fields as ``flow``.

    With ``time``, a timestamp column of the messages, time-outs follow event time. ``fused_lines`` writes the rows out.
    """
    keep = [time] if time else []
    keyed = keyed_results(messages, order, keep=keep)
    fused = correlate_stream(keyed.withColumn("flow", F.to_json("flow", {"ignoreNullFields": "false"})), time=time, **options)
    return fused.withColumn("flow", F.from_json("flow", _FLOW))


def fused_lines(fused: DataFrame, need_features: bool = False) -> DataFrame:
    """(first_arrival, line) of fused rows that some detector flagged, in the form of the batch job's messages.

    Number them per micro-batch with ``writers.OrdinalSink`` under ``PREFIX``, which continues over batches.
    """
    line = C.fused_csv([F.col(f"flow.{name}") for name in NETFLOW12])
    return fused.filter(C.shall_propagate(need_features)).select("first_arrival", line.alias("line"))
