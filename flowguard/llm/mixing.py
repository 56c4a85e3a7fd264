"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

A source of size S and target weight w gets the mean repetition rate r = w * target / S. A document appears as often as
the Poisson(r) quantile of a uniform number hashed from (seed, id) says; copies are then sorted by a hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard.llm.registry import query, table
from flowguard.llm.tables import Stored, free_name

SEED = "mix-1"
DIGITS = 13  # hexadecimal digits of a hash that make a uniform number: 52 bits


def hashed(*parts: Column | str) -> Column:
    """Long of 52 bits from the MD5 digest of the parts, joined by ``|``."""
    text = F.concat_ws("|", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("long")


def uniform(*parts: Column | str) -> Column:
    return (hashed(*parts).cast("double") + 0.5) / float(1 << 4 * DIGITS)


def poisson_steps(rate: Column) -> Column:
    """Cumulative Poisson probabilities from 0 on, far enough for every 52-bit uniform number.

    Probabilities are kept as logarithms, so that large rates do not underflow; a rate of 0 gives one step of 1.
    """
    last = F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int")
    grow = F.aggregate(
        F.sequence(F.lit(1), last),
        F.struct((-rate).alias("log"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("steps")),
        lambda a, k: F.struct(
            (a["log"] + F.log(rate) - F.log(k.cast("double"))).alias("log"),
            (a["sum"] + F.exp(a["log"] + F.log(rate) - F.log(k.cast("double")))).alias("sum"),
            F.concat(a["steps"], F.array(a["sum"] + F.exp(a["log"] + F.log(rate) - F.log(k.cast("double"))))).alias("steps"),
        ),
        lambda a: a["steps"],
    )
    return F.when(rate > 0, grow).otherwise(F.array(F.lit(1.0)))


def source_rates(
    df: DataFrame, source: str, size: Column, weights: DataFrame | None = None, target: float | None = None
) -> DataFrame:
    """One row per source: (source, size, rate, steps).

    ``weights`` has (source, weight); without it every source weighs the same. Sources it does not name, and those with
    a null or negative weight, get rate 0. ``target`` is the wanted total size, by default the present one.
    """
    sizes = df.groupBy(F.col(f"`{source}`").alias("source")).agg(F.sum(size).cast("double").alias("size"))
    if weights is None:
        weighed = sizes.withColumn("weight", F.lit(1.0))
    else:
        w = weights.groupBy(F.col("source").alias("_s")).agg(F.sum("weight").cast("double").alias("weight"))
        weighed = sizes.join(w, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
        weighed = weighed.withColumn("weight", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)))
    totals = weighed.filter(F.col("size") > 0).agg(F.sum("weight").alias("_w"), F.sum("size").alias("_all"))  # one row
    wanted = F.col("_all") if target is None else F.lit(float(target))
    rate = F.when((F.col("size") > 0) & (F.col("_w") > 0), F.col("weight") / F.col("_w") * wanted / F.col("size"))
    rated = weighed.join(F.broadcast(totals)).select("source", "size", F.coalesce(rate, F.lit(0.0)).alias("rate"))
    return rated.withColumn("steps", poisson_steps(F.col("rate")))


def mix_sources(
    df: DataFrame, id_col: str = "doc_id", source: str = "source", size: Column | None = None,
    weights: DataFrame | None = None, target: float | None = None, seed: str = SEED,
) -> DataFrame:
    """Every document as often as its Poisson count says, in a global random order.

    Adds ``copy`` (0, 1, ...), ``n_copies``, ``rate`` and ``shuffle_key`` (long), by which rows are sorted over all
    partitions; columns already called so are replaced. Size defaults to the UTF-8 bytes of ``text``. A null source is a
    source of its own. Rows with equal ids get equal counts; a null id counts as an empty one. A source of empty texts
    only has size 0 and therefore rate 0. An empty table gives an empty one.

    The table of rates has one row per source. It is written first, so Spark knows its size: it is broadcast below
    Spark's threshold only, else joined by shuffling, where adaptive execution splits a large source.
    """
    added = ["copy", "n_copies", "rate", "shuffle_key"]
    rows = df.drop(*added)
    size = F.octet_length("text") if size is None else size
    rates = Stored(source_rates(rows, source, F.coalesce(size, F.lit(0)), weights, target), "rates").df
    key, steps = free_name(rows, "_source"), free_name(rows, "_steps")
    rates = rates.select(F.col("source").alias(key), "rate", F.col("steps").alias(steps))
    u = uniform(seed, F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    # Counted and filtered before the explode; texts move once, in the final sort.
    drawn = rows.join(rates, F.col(f"`{source}`").eqNullSafe(F.col(key)))
    drawn = drawn.withColumn("n_copies", F.size(F.filter(steps, lambda c: c < u))).drop(steps, key)
    copies = drawn.filter("n_copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("n_copies") - 1)))
    copies = copies.withColumn("shuffle_key", hashed(seed, F.lit("order"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), F.col("copy")))
    return copies.select(*[F.col(f"`{c}`") for c in rows.columns], *added).orderBy("shuffle_key")


OP8_SQL = f"""
WITH sizes AS (SELECT source, CAST(sum(strlen(text)) AS DOUBLE) AS size FROM documents GROUP BY source),
rates AS (SELECT source, CASE WHEN size > 0 THEN 1.0 / (SELECT count(*) FROM sizes WHERE size > 0)
    * (SELECT sum(size) FROM sizes) / size ELSE 0.0 END AS rate FROM sizes),
probs AS (SELECT source, rate, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p
    FROM rates, generate_series(0, 400) AS g(k) WHERE rate > 0),
steps AS (SELECT source, rate, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM probs),
draws AS (SELECT *, (CAST(('0x' || substr(md5('{SEED}|' || CAST(doc_id AS VARCHAR)), 1, 13)) AS BIGINT) + 0.5)
    / 4503599627370496.0 AS u FROM documents),
counts AS (SELECT d.doc_id, d.source, s.rate, count(*) FILTER (WHERE s.c < d.u) AS n
    FROM draws d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source GROUP BY d.doc_id, d.source, s.rate)
SELECT c.doc_id, d.text, d.lang, c.source, d.n_chars, CAST(g.i AS INTEGER) AS copy, CAST(c.n AS INTEGER) AS n_copies,
  CAST(round(c.rate * 1000000) AS BIGINT) AS rate_millionths,
  CAST(('0x' || substr(md5('{SEED}|order|' || CAST(c.doc_id AS VARCHAR) || '|' || CAST(g.i AS VARCHAR)), 1, 13)) AS BIGINT) AS shuffle_key
FROM counts c JOIN documents d USING (doc_id), generate_series(0, 400) AS g(i) WHERE g.i < c.n
"""


@query("op8_poisson_mixture", OP8_SQL)
def op8_poisson_mixture(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    mixed = mix_sources(docs)
    return mixed.withColumn("rate_millionths", F.round(F.col("rate") * 1_000_000).cast("long")).drop("rate")
