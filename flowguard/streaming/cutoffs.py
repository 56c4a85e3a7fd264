"""Cutoffs that follow the scores: mergeable quantile sketches per key as versioned stream state.

Every micro-batch folds its scores into one KLL sketch per key (tenant, slot length, whatever the keys say) before anything is
shuffled and merges it with the sketch of the version before. A cutoff is a high quantile of all scores so far; a batch is
judged by the sketches of the batches before it, and by configured or default cutoffs where there are none yet. A repeated
batch reads and writes the versions it did the first time.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.streaming.batches import VersionedTable

LEAST_K, MOST_K = 8, 65_535  # sizes a sketch may have


def sketch_size(error: float) -> int:
    """Sketch parameter for a rank error of ``error`` times the number of scores, at 99 % confidence."""
    size = math.ceil((2.296 / error) ** (1 / 0.9021)) if error > 0 else MOST_K + 1
    if size > MOST_K:
        raise ValueError(f"a sketch cannot have a rank error of {error}")
    return max(size, LEAST_K)


class CutoffSketches:
    """Sketches per key of all scores up to a batch, in one folder per batch."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str] = (), score: str = "score", q: float = 0.999, error: float = 0.001):
        self.table = VersionedTable(spark, path)
        self.keys, self.score, self.q, self.k = list(keys), score, q, sketch_size(error)

    def update(self, scored: DataFrame, batch: int) -> None:
        """Write the version of ``batch``: the one before it and the batch's scores; null scores do not count."""
        fresh = scored.filter(F.col(self.score).isNotNull()).groupBy(*self.keys).agg(
            F.kll_sketch_agg_double(F.col(self.score).cast("double"), F.lit(self.k)).alias("sketch"), F.count("*").alias("n"))
        before = self.table.before(batch)
        if before is not None:
            fresh = before.select(*fresh.columns).unionByName(fresh.filter("n > 0")).groupBy(*self.keys).agg(
                F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n").alias("n"))
        self.table.write(batch, fresh.filter("n > 0"))
        self.table.drop_before(batch)

    def cutoffs(self, batch: int) -> DataFrame | None:
        """(keys, cutoff, n): whole numbers at the quantile of all scores before ``batch``; None before the first one."""
        before = self.table.before(batch)
        if before is None:
            return None
        cutoff = F.floor(F.kll_sketch_get_quantile_double("sketch", F.lit(self.q))).cast("bigint")
        return before.select(*self.keys, cutoff.alias("cutoff"), "n")

    def judge(self, scored: DataFrame, batch: int, fallback: Column) -> DataFrame:
        """Add ``cutoff`` and ``is_anomalous``: the sketches' cutoff of the row's key, else ``fallback``.

        There is one cutoff per key. The join is a plain one: Spark broadcasts the cutoffs if the file is small, else splits
        large keys at run time.
        """
        known = self.cutoffs(batch)
        if known is None:
            out = scored.withColumn("cutoff", fallback.cast("bigint"))
        elif self.keys:
            out = scored.join(known.select(*self.keys, F.col("cutoff").alias("_found")), self.keys, "left")
            out = out.withColumn("cutoff", F.coalesce("_found", fallback.cast("bigint"))).drop("_found")
        else:
            out = scored.join(F.broadcast(known.select(F.col("cutoff").alias("_found"))), how="left")  # one row
            out = out.withColumn("cutoff", F.coalesce("_found", fallback.cast("bigint"))).drop("_found")
        return out.withColumn("is_anomalous", F.col(self.score) > F.col("cutoff"))
