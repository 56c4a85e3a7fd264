"""Flow messages to edge burst verdicts, and cutoff retraining from history."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard.functions.scalar import epoch_seconds, ip_to_long32, slot_seconds
from flowguard.operators import edges as E
from flowguard.operators.metrics import retrained_cutoff
from flowguard.session import checkpointed
from flowguard.sources.parse import edge_fields, split_by_width
from flowguard.sources.writers import result_csv


Address = Callable[[Column], Column]


def edges_of(messages: DataFrame, order: str = "id", value: str = "value", address: Address = ip_to_long32) -> DataFrame:
    """Messages of a known width whose time and addresses parse, as (order, value, epoch, src, dst).

    ``address`` reads an address as a number, null if it is none.
    """
    return _parsed(messages, order, value, address).filter("epoch is not null and src is not null and dst is not null")


def _parsed(messages: DataFrame, order: str, value: str, address: Address) -> DataFrame:
    fits, _ = split_by_width(messages, value=value)
    fields = fits.select(order, value, *edge_fields(F.col(value)))
    return fields.select(
        order, value, epoch_seconds(F.col("ts")).alias("epoch"), address(F.col("source")).alias("src"),
        address(F.col("destination")).alias("dst"),
    )


def rejects(messages: DataFrame, order: str = "id", value: str = "value", address: Address = ip_to_long32) -> DataFrame:
    """(order, value, reason): messages that no edge is read from, by width, time or address."""
    _, odd = split_by_width(messages, value=value)
    reason = F.when(F.col("epoch").isNull(), "time").when(F.col("src").isNull() | F.col("dst").isNull(), "address")
    unread = _parsed(messages, order, value, address).withColumn("reason", reason).filter("reason is not null").select(order, value, "reason")
    return odd.select(order, value, F.lit("width").alias("reason")).unionByName(unread)


def score_messages(
    messages: DataFrame, slot: str = "1m", cutoff: int | None = None, order: str = "id", mode: str = "sketch",
    only_anomalies: bool = False, address: Address = ip_to_long32, **scorer,
) -> DataFrame:
    """(order, score, is_anomalous, value): scored messages ready for the result topic."""
    length = slot_seconds(slot)
    if cutoff is None:
        label = f"{slot[:-1]}{'min' if slot.endswith('m') else 'sec'}"
        cutoff = E.DEFAULT_CUTOFF.get(label, E.FALLBACK_CUTOFF)
    # Parsed once: the scorer reads its narrow input several times.
    edges = checkpointed(edges_of(messages, order, address=address).drop("value"))
    slotted = E.with_slots(edges, "epoch", length, order)
    scored = E.filtered_burst(slotted, order, mode=mode, **scorer).select(order, "score")
    out = messages.select(order, "value").join(scored, order).withColumn("is_anomalous", F.col("score") > cutoff)
    if only_anomalies:
        out = out.filter("is_anomalous")
    payload = result_csv(F.col("value"), "MIDAS", None, F.col("score"), F.col("is_anomalous"))
    return out.select(order, "score", "is_anomalous", payload.alias("value"))


def retrain_cutoff(history: DataFrame, slot: str = "1m", order: str = "id", mode: str = "sketch", address: Address = ip_to_long32, **scorer) -> DataFrame:
    """New cutoff from historical messages, with the range of their scores."""
    edges = checkpointed(edges_of(history, order, address=address).drop("value"))
    slotted = E.with_slots(edges, "epoch", slot_seconds(slot), order)
    return retrained_cutoff(checkpointed(E.filtered_burst(slotted, order, mode=mode, **scorer)), "score")
