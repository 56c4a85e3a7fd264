"""Fusing the results of several detectors per flow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard.schema import MODULES

# Which detectors must have answered before a flow may be emitted early.
EARLY_RULES = {"ALL": MODULES, "MIDAS_IFOREST": ["MIDAS", "IFOREST"], "IFOREST_GANomaly": ["IFOREST", "GANomaly"]}


def fuse(results: DataFrame, key: str = "key", arrival: str = "arrival", flow: list[str] = ()) -> DataFrame:
    """One row per flow: the first result of each detector and the first-seen flow fields.

    ``results`` has (key, module, score, is_anomalous, features, arrival). Folding happens
    before the shuffle, so a key with very many repeats costs one partial row per task.
    """
    first = [
        F.expr(
            f"min_by(struct(score, is_anomalous, features), {arrival}) FILTER (WHERE module = '{m}')"
        ).alias(m.lower())
        for m in MODULES
    ]
    seen = F.min_by(F.struct(*flow), arrival).alias("flow") if flow else F.lit(None).alias("flow")
    return results.filter(F.col("module").isin(*MODULES)).groupBy(key).agg(
        *first, seen, F.min(arrival).alias("first_arrival")
    )


def any_anomalous() -> Column:
    flags = [F.coalesce(F.col(f"{m.lower()}.is_anomalous"), F.lit(False)) for m in MODULES]
    return F.greatest(*flags)


def shall_propagate(need_features: bool = False) -> Column:
    """At least one detector raised a flag, and model features are there when required."""
    verdict = any_anomalous()
    if need_features:
        verdict = verdict & (F.col("ae").isNotNull() | F.col("iforest").isNotNull())
    return verdict


def complete(rule: str = "ALL") -> Column:
    """All detectors of the rule have answered."""
    verdict = F.lit(True)
    for m in EARLY_RULES[rule]:
        verdict = verdict & F.col(m.lower()).isNotNull()
    return verdict


def model_features() -> Column:
    """Feature list of the autoencoder, else of the forest."""
    return F.coalesce(F.col("ae.features"), F.col("iforest.features"))


def fused_csv(flow: list[Column]) -> Column:
    """Flow fields, score and flag per detector (``None`` when missing), then features."""
    text = [F.coalesce(c.cast("string"), F.lit("")) for c in flow]
    for m in MODULES:
        text.append(F.coalesce(F.col(f"{m.lower()}.score").cast("string"), F.lit("None")))
        text.append(
            F.when(F.col(m.lower()).isNull(), "None")
            .when(F.col(f"{m.lower()}.is_anomalous"), "1")
            .otherwise("0")
        )
    line = F.concat_ws(",", *text)
    features = model_features()
    return F.when(features.isNull(), line).otherwise(F.concat(line, F.lit(","), features))
