"""Connected components by repeated contraction, in DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.tables import Stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the edges (a, b), both long; ``component`` is one of its nodes.

    In each round a node joins its smallest neighbour (or itself) and edges are renamed and folded, until none is left.
    Node numbers should be hashes, so that the number of rounds grows with the logarithm of the longest path. Hubs are
    aggregated before the shuffle. No edges give an empty frame.
    """
    spark = edges.sparkSession
    maps: list[Stored] = []
    left = Stored(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    while not left.df.isEmpty():
        both = left.df.union(left.df.select("b", "a"))
        near = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
        step = Stored(near.select("node", F.least("node", "b").alias("up")), "map")
        maps.append(step)
        a, b = step.df.toDF("a", "ua"), step.df.toDF("b", "ub")
        renamed = left.df.join(a, "a").join(b, "b").filter("ua <> ub")
        folded = renamed.select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct()
        following = Stored(folded, "edges")
        left.drop()
        left = following
    left.drop()
    if not maps:
        return spark.createDataFrame([], "node long, component long")
    found = maps[-1].df.withColumnRenamed("up", "component")
    for step in maps[-2::-1]:
        upper = found.toDF("up", "component")
        found = step.df.join(upper, "up", "left").select("node", F.coalesce("component", "up").alias("component"))
    kept = Stored(found, "components")
    for step in maps:
        step.drop()
    return kept.df
