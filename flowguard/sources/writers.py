"""Result payloads and message sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard.operators.scan import CHUNK_BITS, running
from flowguard.session import checkpointed


def result_csv(raw: Column, module: str, features: Column | None, score: Column, flag: Column) -> Column:
    """Flow CSV followed by module, quoted feature list, score and 0/1 flag."""
    listed = F.lit("") if features is None else F.array_join(features.cast("array<string>"), ",")
    return F.concat_ws(
        ",",
        raw,
        F.lit(module),
        F.concat(F.lit('"['), listed, F.lit(']"')),
        F.format_string("%.6f", score),
        F.when(flag, "1").otherwise("0"),
    )


def alert_json(fields: Column, method: Column | str, score: Column) -> Column:
    method = F.lit(method) if isinstance(method, str) else method
    return F.to_json(F.struct(fields.alias("in_data"), method.alias("method"), score.alias("score")))


def method_label(slot: Column | str, cutoff: Column | int) -> Column:
    """Detector label that names its slot length and cutoff."""
    slot = F.lit(slot) if isinstance(slot, str) else slot
    cutoff = F.lit(cutoff) if isinstance(cutoff, int) else cutoff
    return F.format_string("MIDAS-F(slot: %s, score thr: %d)", slot, cutoff.cast("bigint"))


def keyed_messages(
    df: DataFrame, value: str, order: str, prefix: str, partition: int | None = None, bits=CHUNK_BITS, first: int = 0
) -> DataFrame:
    """(key, value[, partition]) rows; keys carry the message ordinal, counted from ``first``."""
    numbered = running(df, [], order, {"_n": ("sum", F.lit(1).cast("bigint"))}, bits)
    columns = [
        F.concat(F.lit(prefix), (F.col("_n") - 1 + first).cast("string")).alias("key"),
        F.col(value).alias("value"),
    ]
    if partition is not None:
        columns.append(F.lit(partition).alias("partition"))
    return numbered.select(*columns)


def write_messages(df: DataFrame, format: str = "kafka", path: str | None = None, **options: str) -> None:
    writer = df.write.format(format).options(**options)
    if format != "kafka":
        writer = writer.mode("append")
    writer.save(path) if path else writer.save()


def write_by_tenant(df: DataFrame, path: str, tenant: str = "tenant_id", format: str = "parquet") -> None:
    """File layout with one directory per tenant, the counterpart of a partition per tenant."""
    df.write.mode("append").partitionBy(tenant).format(format).save(path)


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Write a stage and continue from what was written."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class OrdinalSink:
    """Micro-batch sink of keyed messages whose ordinals go on from batch to batch.

    The next free ordinal is stored per batch id, so a repeated batch gets the numbers it had.
    """

    def __init__(self, marks, out, value: str, order: str, prefix: str, partition: int | None = None):
        self.marks, self.out = marks, out
        self.options = dict(value=value, order=order, prefix=prefix, partition=partition)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        before = self.marks.before(batch_id)
        first = before.first()["next"] if before is not None else 0
        rows = checkpointed(batch)
        self.out(keyed_messages(rows, first=first, **self.options), batch_id)
        self.marks.write(batch_id, rows.agg((F.count("*") + first).alias("next")))
        self.marks.drop_before(batch_id)
