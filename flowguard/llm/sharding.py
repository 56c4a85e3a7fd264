"""Reproducible shuffle and shards: a Feistel permutation with cycle walking over global row numbers.

Row i of N goes to position p(i), p being a seeded permutation of 0..N-1; shard = p mod shards, slot = p div shards.
Both follow from (i, N, shards, seed) alone, so any worker can compute where a row is, and which row sits in a slot.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.llm.grams import mix
from flowguard.llm.registry import query, table
from flowguard.llm.tables import Stored, free_name

U = np.uint64
SHARDS, SEED, ROUNDS = 24, 20_261, 6


def half_bits(n: int) -> int:
    """Bits of each half of the smallest balanced Feistel domain that holds 0..n-1."""
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _once(x: np.ndarray, bits: int, keys: np.ndarray) -> np.ndarray:
    mask = U((1 << bits) - 1)
    left, right = x >> U(bits), x & mask
    for key in keys:
        left, right = right, left ^ (mix(right + key) & mask)
    return (left << U(bits)) | right


def _once_back(x: np.ndarray, bits: int, keys: np.ndarray) -> np.ndarray:
    mask = U((1 << bits) - 1)
    left, right = x >> U(bits), x & mask
    for key in keys[::-1]:
        left, right = right ^ (mix(left + key) & mask), left
    return (left << U(bits)) | right


def _walk(step, rows, n: int, seed: int) -> np.ndarray:
    """Apply ``step`` until every value is below n again; cycles of a permutation always come back."""
    keys = mix(np.arange(1, ROUNDS + 1, dtype=U) + (U(seed % (1 << 64)) << U(8)))
    bits = half_bits(n)
    out = step(np.asarray(rows).astype(U), bits, keys)
    while (far := np.flatnonzero(out >= U(n))).size:
        out[far] = step(out[far], bits, keys)
    return out.astype(np.int64)


def permute(rows, n: int, seed: int = SEED) -> np.ndarray:
    """Positions of row numbers 0 <= rows < n."""
    return _walk(_once, rows, n, seed)


def row_at(shard, slot, n: int, shards: int = SHARDS, seed: int = SEED) -> np.ndarray:
    """Row numbers that sit in the given slots: the inverse of ``permute``."""
    return _walk(_once_back, np.asarray(slot).astype(np.int64) * shards + np.asarray(shard), n, seed)


def with_row_numbers(df: DataFrame, order: list[str], name: str) -> tuple[DataFrame, int]:
    """Add gapless row numbers by the order columns, and return the number of rows.

    The frame is range-partitioned once and written, with its place inside its partition; a partition's first number
    is the sum of the counts before it. Ties are ordered by a hash of the whole row, so rows that still tie are equal.
    """
    place = free_name(df, "_place")
    kinds = dict(df.dtypes)
    keys = [F.col(f"`{c}`") for c in order] + [F.xxhash64(*[F.col(f"`{c}`") for c, t in kinds.items() if "map<" not in t])]
    kept = Stored(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(place, F.monotonically_increasing_id()), "numbered"
    )
    part = F.shiftright(place, 33).cast("int")
    # One row per partition of the table above: far below a million, whatever the data.
    counts = sorted((r[0], r[1]) for r in kept.df.groupBy(part.alias("part")).count().collect())
    starts, total = [], 0
    for number, count in counts:
        starts.append((number, total))
        total += count
    offsets = df.sparkSession.createDataFrame(starts, "_part int, _start long")
    rows = kept.df.join(F.broadcast(offsets), part == F.col("_part"))
    inside = F.col(place).bitwiseAND(F.lit((1 << 33) - 1))
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_start") + inside).alias(name)), total


def shard_rows(df: DataFrame, order: list[str], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Add ``shard`` (int, 0 to shards - 1) and ``slot`` (long, gapless from 0 in each shard) to every row.

    Row numbers follow the order columns, nulls first. Equal rows each get a place of their own; which of them gets
    which cannot be told apart. Columns already called shard or slot are replaced. An empty table gives an empty one.
    Shards differ by one row at most, whatever the keys, texts or sources of the rows.
    """
    rows = df.drop("shard", "slot")
    number = free_name(rows, "_row")
    numbered, n = with_row_numbers(rows, order, number)

    @F.pandas_udf("long")
    def position(x):
        import pandas as pd

        return pd.Series(permute(x.to_numpy(), n, seed), index=x.index)

    at = free_name(rows, "_at")
    return numbered.withColumn(at, position(F.col(number))).select(
        *[F.col(f"`{c}`") for c in rows.columns],
        F.pmod(at, F.lit(shards)).cast("int").alias("shard"),
        F.expr(f"{at} div {shards}").cast("long").alias("slot"),
    )


def write_shards(df: DataFrame, path: str) -> None:
    """One folder per shard, rows of a file in slot order."""
    df.repartition("shard", F.shiftright("slot", 16)).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


@query("op1_feistel_shards")
def op1_feistel_shards(spark, folder):
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, folder, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).cast("long").alias("text_crc32")
    )
    return shard_rows(rows, ["doc_id"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
