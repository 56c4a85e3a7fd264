"""Running aggregates over ordered data without putting one group into one task.

``running`` serves integer arrival orders: a group is cut into chunks of at most ``2**bits``
rows by the high bits of the (unique) order key, chunk totals are added up level by level, and
rows only ever meet rows of their own chunk.  ``running_by_value`` serves ordering by a
measured value: rows are range-partitioned, and partition totals are carried over.
``halo`` copies rows to the neighbouring time buckets that can see them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowguard.session import checkpointed, scan_parallelism

CHUNK_BITS = (16, 32)


def _combine(kind: str, a: Column, b: Column) -> Column:
    if kind == "sum":
        return F.coalesce(a + b, a, b)
    return F.greatest(a, b) if kind == "max" else F.least(a, b)


def _agg(kind: str, c: Column) -> Column:
    return {"sum": F.sum, "max": F.max, "min": F.min}[kind](c)


def _exclusive(kind: str, value: Column, keys: list[str], order: str) -> Column:
    window = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    return _agg(kind, value).over(window)


def chunk_carries(
    totals: DataFrame, keys: list[str], kinds: dict[str, str], bits=CHUNK_BITS
) -> DataFrame:
    """Per (keys, _c0) what the earlier chunks of the group add up to.

    ``totals`` has one row per (keys, _c0) with a column per entry of ``kinds``; the result
    keeps those and adds ``_carry_<name>``, null for the first chunk.
    """
    step = bits[1] - bits[0]
    leveled = totals.withColumn("_c1", F.shiftright("_c0", step))
    upper = leveled.groupBy(*keys, "_c1").agg(*[_agg(k, F.col(n)).alias(n) for n, k in kinds.items()])
    upper = upper.select(
        *keys, "_c1", *[_exclusive(k, F.col(n), keys, "_c1").alias(f"_up_{n}") for n, k in kinds.items()]
    )
    lower = leveled.select(
        "*", *[_exclusive(k, F.col(n), [*keys, "_c1"], "_c0").alias(f"_low_{n}") for n, k in kinds.items()]
    )
    joined = attach(lower, upper, [*keys, "_c1"])
    for name, kind in kinds.items():
        joined = joined.withColumn(
            f"_carry_{name}", _combine(kind, F.col(f"_up_{name}"), F.col(f"_low_{name}"))
        ).drop(f"_up_{name}", f"_low_{name}")
    return joined.drop("_c1")


def attach(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on plain equality, so that windows over the same keys reuse its partitioning."""
    return _in_order(left.join(right, keys, "left"), left, right)


def _in_order(joined: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns of the left side first, then what the right side adds."""
    names = [*left.columns, *[c for c in right.columns if c not in left.columns]]
    return joined.select(*[F.col(f"`{c}`") for c in names])


def all_present(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys], F.lit(True))


def running(
    df: DataFrame,
    keys: list[str],
    order: str,
    values: dict[str, tuple[str, Column]],
    bits=CHUNK_BITS,
) -> DataFrame:
    """Add inclusive running aggregates per group in the order of a unique integer column.

    ``values`` maps an output name to (``sum``/``max``/``min``, expression). Rows with a null
    key belong to no group and get null.
    """
    kinds = {n: kind for n, (kind, _) in values.items()}
    rows = df.withColumn("_c0", F.shiftright(F.col(order).cast("bigint"), bits[0]))
    totals = rows.groupBy(*keys, "_c0").agg(*[_agg(k, e).alias(n) for n, (k, e) in values.items()])
    carries = chunk_carries(totals, keys, kinds, bits).drop(*values)
    local = Window.partitionBy(*[F.col(k) for k in keys], F.col("_c0")).orderBy(order).rowsBetween(
        Window.unboundedPreceding, 0
    )
    out = attach(rows, carries, [*keys, "_c0"])
    for name, (kind, expr) in values.items():
        value = _combine(kind, F.col(f"_carry_{name}"), _agg(kind, expr).over(local))
        out = out.withColumn(name, F.when(all_present(keys), value) if keys else value)
    return out.drop("_c0", *[f"_carry_{n}" for n in values])


def running_by_value(
    df: DataFrame,
    order: str,
    sums: dict[str, Column],
    keys: list[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Inclusive running sums in value order, plus ``_next``, the following value of the group.

    ``df`` holds one row per (keys, order): aggregate duplicates first. The frame is written
    once to the checkpoint folder so that partition bounds are the same for totals and rows.
    """
    keys = list(keys)
    sort = F.col(order).desc() if descending else F.col(order).asc()
    parts = scan_parallelism(df.sparkSession)
    ranged = checkpointed(
        df.select("*", *[e.cast("double" if _is_double(df, e) else "bigint").alias(f"_v_{n}") for n, e in sums.items()])
        .repartitionByRange(parts, *[F.col(k) for k in keys], sort)
        .withColumn("_pid", F.spark_partition_id())
    )
    first = F.max if descending else F.min
    carry = ranged.groupBy(*keys, "_pid").agg(
        *[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums], first(order).alias("_first")
    )
    across = Window.partitionBy(*keys).orderBy("_pid")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    carry = carry.select(
        *keys,
        "_pid",
        *[F.sum(f"_t_{n}").over(before).alias(f"_b_{n}") for n in sums],
        F.lead("_first").over(across).alias("_following"),
    )
    inside = Window.partitionBy(*keys, "_pid").orderBy(sort)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    out = attach(ranged, carry, [*keys, "_pid"])
    for name in sums:
        out = out.withColumn(
            name, F.coalesce(F.col(f"_b_{name}"), F.lit(0)) + F.sum(f"_v_{name}").over(upto)
        )
    out = out.withColumn("_next", F.coalesce(F.lead(order).over(inside), F.col("_following")))
    return out.drop("_pid", "_following", *[f"_v_{n}" for n in sums], *[f"_b_{n}" for n in sums])


def _is_double(df: DataFrame, expr: Column) -> bool:
    return df.select(expr.alias("x")).schema["x"].dataType.typeName() in ("double", "float")


def halo(df: DataFrame, sec: str, bucket: int, back: int = 0, ahead: int = 0) -> DataFrame:
    """One copy of each row per time bucket that holds an instant within [sec-ahead, sec+back].

    ``_bucket`` is the receiving bucket, ``_own`` marks the copy that belongs to it.
    """
    first = F.floor((F.col(sec) - ahead) / bucket).cast("bigint")
    last = F.floor((F.col(sec) + back) / bucket).cast("bigint")
    own = F.floor(F.col(sec) / bucket).cast("bigint")
    return df.withColumn("_bucket", F.explode(F.sequence(first, last))).withColumn(
        "_own", F.col("_bucket") == own
    )


def spread_join(
    rows: DataFrame, lookup: DataFrame, on: list[str], spread_by: str, ways: int = 16, how: str = "left", large: bool = False
) -> DataFrame:
    """Join rows to a lookup with unique keys so that one hot key is shared by ``ways`` tasks.

    The lookup is copied ``ways`` times: meant for tables far smaller than the rows, such as one
    row per second. ``skew_join`` serves large lookups. Spark's size estimate leaves the copies out, so a lookup that grows
    with time or data must be called ``large``: it is then sorted and merged, never broadcast through the driver.
    """
    left = rows.withColumn("_way", F.pmod(F.xxhash64(spread_by), F.lit(ways)).cast("int"))
    right = lookup.withColumn("_way", F.explode(F.sequence(F.lit(0), F.lit(ways - 1))))
    right = right.hint("merge") if large else right
    return _in_order(left.join(right, [*on, "_way"], how), left, right).drop("_way")


def skew_join(
    rows: DataFrame, lookup: DataFrame, on: list[str], spread_by: str, ways: int = 64, share: int = 10_000, how: str = "left",
    salt: bool = False,
) -> DataFrame:
    """Join rows to a large lookup with unique keys.

    By default Spark's adaptive execution splits partitions that turn out large: either side is read and shuffled once. It
    cannot do so where the result's partitioning is used further on; ``salt`` then spreads hot keys itself, for another read
    of ``rows``, which should be a stored table. A key is hot if it holds more than 1/``share`` of the rows, so there are
    fewer than ``share`` of them: the list is small enough to broadcast, whatever the data. Only their lookup rows are copied.
    """
    if not salt:
        return _in_order(rows.join(lookup, on, how), rows, lookup)
    counts = rows.groupBy(*on).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").alias("_all"))
    hot = counts.join(F.broadcast(total)).filter(F.col("_n") * share > F.col("_all"))
    hot = F.broadcast(hot.select(*on, F.lit(ways).alias("_ways")))
    way = F.when(F.col("_ways").isNotNull(), F.pmod(F.xxhash64(spread_by), F.lit(ways))).otherwise(0).cast("int")
    left = rows.join(hot, on, "left").withColumn("_way", way).drop("_ways")
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_ways"), F.lit(1)) - 1)
    right = lookup.join(hot, on, "left").withColumn("_way", F.explode(copies)).drop("_ways")
    return _in_order(left.join(right, [*on, "_way"], how), left, right).drop("_way")
