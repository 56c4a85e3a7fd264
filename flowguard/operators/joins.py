"""Flow and connection joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.operators.scan import skew_join, spread_join

CONNECTION_KEYS = {"sa": "id.orig_h", "da": "id.resp_h", "sp": "id.orig_p", "dp": "id.resp_p"}


def keep_last(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Last row per key in ``order``; folded before the shuffle, so hot keys stay small."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
        F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.col(f"`{order}`")).alias("_row")
    )
    return picked.select(*[F.col(f"`{k}`") for k in keys], "_row.*")


def merge_connections(flows: DataFrame, connections: DataFrame, id: str = "id", order: str = "ts") -> DataFrame:
    """Every flow with its last matching connection, if any."""
    renamed = connections.withColumnsRenamed({v: k for k, v in CONNECTION_KEYS.items()})
    latest = keep_last(renamed, list(CONNECTION_KEYS), order)
    clash = [c for c in latest.columns if c in flows.columns and c not in CONNECTION_KEYS]
    return skew_join(flows, latest.drop(*clash), list(CONNECTION_KEYS), id)


def unmatched(left: DataFrame, right: DataFrame, on: list[str], id: str) -> DataFrame:
    """Rows of ``left`` without a partner; only the distinct keys of ``right`` are shuffled."""
    partners = right.select(*on).distinct().withColumn("_partner", F.lit(True))
    return skew_join(left, partners, on, id).filter("_partner is null").drop("_partner")


def rejoin_scores(rows: DataFrame, scores: DataFrame, id: str = "id") -> DataFrame:
    """Original rows with their scores, by event id, without repeats."""
    return rows.join(scores, id, "inner").distinct()


def with_tenant_partition(df: DataFrame, tenants: DataFrame, id: str, tenant: str = "tenant_id") -> DataFrame:
    """Look up the message partition of each row's tenant."""
    return spread_join(df, tenants.select(tenant, "partition"), [tenant], id)
