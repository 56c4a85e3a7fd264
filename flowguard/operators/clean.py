"""Filters, null handling and category repair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard.functions.scalar import ipv4_to_long
from flowguard.operators.scan import CHUNK_BITS, running
from flowguard.session import checkpointed

# Protocols and service types the detectors accept or refuse.
FOREST_DENIED = ("HOP", "SCTP")
TWO_VIEW_DENIED = ("ICMP", "IGMP", "ICMP6")
ALLOWED_STOS = (0, 1, 2, 3)
MISSING_HISTORY = "$"
FLAG_OVERRIDE = "...APRS."
TENANT_PATTERN = "^(ANY_TENANT|[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12})$"


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Casts in one projection; values that do not fit become null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def deny(df: DataFrame, column: str, values) -> DataFrame:
    return df.filter(~F.col(column).isin(*values))


def allow(df: DataFrame, column: str, values) -> DataFrame:
    return df.filter(F.col(column).isin(*values))


def has_history(df: DataFrame, column: str = "zeek") -> DataFrame:
    return df.filter(F.col(column) != MISSING_HISTORY)


def override(df: DataFrame, column: str, value: str, keep_as: str | None = None) -> DataFrame:
    if keep_as:
        df = df.withColumn(keep_as, F.col(column))
    return df.withColumn(column, F.lit(value))


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: the number of nulls per column."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns or df.columns])


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Remove every column that holds a null; one pass over the data."""
    counts = null_counts(df).first().asDict()
    return df.drop(*[c for c, n in counts.items() if n])


def drop_constant_columns(df: DataFrame) -> DataFrame:
    """Remove columns with at most one value; min = max tells without counting distinct values."""
    spread = df.agg(
        *[F.coalesce(F.min(f"`{c}`") != F.max(f"`{c}`"), F.lit(False)).alias(c) for c in df.columns]
    ).first().asDict()
    return df.drop(*[c for c, varies in spread.items() if not varies])


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n_distinct) rows; values are folded before the shuffle."""
    cells = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in columns])
        ).alias("_c")
    ).select("_c.*")
    return cells.filter("v is not null").distinct().groupBy("column").agg(F.count("*").alias("n_distinct"))


def unseen(df: DataFrame, column: str, known: list[str]) -> DataFrame:
    """Distinct values outside the known set."""
    return df.select(column).filter(~F.col(column).isin(*known)).distinct()


def nearest_known(value: Column, known: list[str]) -> Column:
    """The value itself if known, else the first known value at the least edit distance.

    ``known`` is an encoder's class list, so the comparison is a literal array and no join.
    """
    choices = F.array(
        *[F.struct(F.levenshtein(value, F.lit(k)).alias("d"), F.lit(i).alias("i"), F.lit(k).alias("k")) for i, k in enumerate(known)]
    )
    return F.when(value.isin(*known), value).when(value.isNotNull(), F.array_min(choices)["k"])


def nearest_category(df: DataFrame, column: str, known: DataFrame, category: str = "category", order: str = "order", reach: int = 2) -> DataFrame:
    """``df`` with ``column`` replaced by the known category at the least edit distance, the first by ``order`` among equals.

    For class lists of any length. Distinct values meet categories that share what is left after deleting up to ``reach``
    letters, which all categories within that distance do; the edit distance then judges candidates only. Values with no
    category in reach are compared with all of them, in blocks of ``BLOCK`` categories. Null values stay null; a category
    listed twice counts where it comes first; without categories all values become null.
    """
    key = "_nearest"
    names = known.filter(F.col(category).isNotNull()).groupBy(F.col(category).alias("k")).agg(F.min(order).alias("i"))
    names = checkpointed(names)
    values = checkpointed(df.select(F.col(column).alias("v")).filter("v IS NOT NULL").distinct())
    step = F.struct(F.levenshtein(F.col("v"), F.col("k")).alias("d"), "i", "k")
    met = values.withColumn("part", F.explode(_shortened(F.col("v"), reach))).join(names.withColumn("part", F.explode(_shortened(F.col("k"), reach))), "part")
    near = checkpointed(met.select("v", step.alias("s")).groupBy("v").agg(F.min("s").alias("s")).filter(F.col("s.d") <= reach))
    rest = values.join(near, "v", "left_anti")
    blocks = max(1, -(-names.count() // BLOCK))
    spread = names.groupBy(F.pmod(F.xxhash64("k"), F.lit(blocks)).alias("block")).agg(F.collect_list(F.struct("i", "k")).alias("all"))
    far = rest.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))).join(spread, "block")
    far = far.select("v", F.array_min(F.transform("all", lambda c: F.struct(F.levenshtein(F.col("v"), c["k"]).alias("d"), c["i"].alias("i"), c["k"].alias("k")))).alias("s"))
    found = near.unionByName(far.groupBy("v").agg(F.min("s").alias("s"))).select(F.col("v").alias(key), F.col("s.k").alias("_k"))
    joined = df.join(found, F.col(column) == F.col(key), "left")
    return joined.select(*[F.col("_k").alias(c) if c == column else F.col(f"`{c}`") for c in df.columns])


BLOCK = 1000


def _shortened(text: Column, letters: int) -> Column:
    """The text and every text left after deleting up to so many letters, each once."""
    out = F.array(text)
    for _ in range(letters):
        out = F.array_distinct(F.concat(out, F.flatten(F.transform(out, lambda t: F.when(F.length(t) > 0, F.transform(
            F.sequence(F.lit(1), F.length(t)), lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t))))).otherwise(F.array(t))))))
    return out


def encode_addresses(
    df: DataFrame, source: str = "sa", destination: str = "da", order: str = "id", bits=CHUNK_BITS
) -> DataFrame:
    """IPv4 text to integers; other text gets codes shared by both columns in order of first use."""
    # Both columns meet the codes in one join, on a narrow stored table, and return to their rows in another.
    side = [F.struct(F.lit(i).alias("side"), F.col(c).alias("v")) for i, c in enumerate((source, destination))]
    text = df.select(F.col(order).alias("_o"), F.explode(F.array(*side)).alias("_s")).select("_o", "_s.*")
    text = checkpointed(text.filter(F.col("v").isNotNull() & ipv4_to_long(F.col("v")).isNull()))
    firsts = checkpointed(text.groupBy("v").agg(F.min(F.col("_o").cast("bigint") * 2 + F.col("side")).alias("at")))
    codes = running(firsts, [], "at", {"code": ("sum", F.lit(1).cast("bigint"))}, bits).select("v", (F.col("code") - 1).alias("code"))
    coded = text.join(codes, "v").groupBy("_o").agg(*[F.max(F.when(F.col("side") == i, F.col("code"))).alias(f"_code{i}") for i in (0, 1)])
    out = df.join(coded, F.col(order) == F.col("_o"), "left")
    for i, c in enumerate((source, destination)):
        out = out.withColumn(c, F.coalesce(ipv4_to_long(F.col(c)), F.col(f"_code{i}")).cast("double"))
    return out.drop("_o", "_code0", "_code1")


def is_tenant(column: Column) -> Column:
    return column.rlike(TENANT_PATTERN)
