"""Bounded and continuous readers. The Kafka connector and file formats share one shape."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowguard.schema import CONN, KAFKA_RECORD, string_schema


ADDRESSED = ("kafka", "message_log")  # formats that bring the record schema and know offsets


def kafka_options(
    brokers: str,
    topic: str,
    partition: int | None = None,
    start: str | int = "latest",
    group: str | None = None,
    fail_on_data_loss: bool = False,
) -> dict[str, str]:
    """Reader options: one tenant partition (``assign``) or the whole topic (``subscribe``)."""
    options = {"kafka.bootstrap.servers": brokers, "failOnDataLoss": str(fail_on_data_loss).lower()}
    if partition is None:
        options["subscribe"] = topic
    else:
        options["assign"] = json.dumps({topic: [partition]})
    if isinstance(start, int):
        options["startingOffsets"] = json.dumps({topic: {str(partition or 0): start}})
    else:
        options["startingOffsets"] = start
    if group:
        options["kafka.group.id"] = group
    return options


def read_records(spark: SparkSession, format: str = "kafka", path: str | None = None, **options: str) -> DataFrame:
    """Bounded scan of (key, value, topic, partition, offset, timestamp) records."""
    reader = spark.read.format(format).options(**options)
    if format not in ADDRESSED:
        reader = reader.schema(KAFKA_RECORD)
    return reader.load(path) if path else reader.load()


def stream_records(spark: SparkSession, format: str = "kafka", path: str | None = None, **options: str) -> DataFrame:
    """Continuous version of ``read_records``; directories of files stand in for topics."""
    reader = spark.readStream.format(format).options(**options)
    if format not in ADDRESSED:
        reader = reader.schema(KAFKA_RECORD)
    return reader.load(path) if path else reader.load()


def tenant_partition(records: DataFrame, tenants: DataFrame, tenant_id: str) -> DataFrame:
    """Rows of the partition assigned to one tenant."""
    wanted = tenants.filter(F.col("tenant_id") == tenant_id).select("partition")
    return records.join(wanted, "partition", "left_semi")


def since_offset(records: DataFrame, offset: int | Column) -> DataFrame:
    return records.filter(F.col("offset") >= offset)


def read_flow_csv(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """CSV flow export with a header; fields stay text."""
    return spark.read.option("header", True).schema(string_schema(names)).csv(path)


def read_inferred_csv(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    return spark.read.option("inferSchema", True).option("header", header).csv(path)


def read_conn_log(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated connection log; header and trailer lines are comments, ``-`` is missing."""
    raw = spark.read.schema(string_schema(CONN)).csv(path, sep="\t", comment="#", nullValue="-", quote="")
    return raw.withColumn("duration", F.col("duration").try_cast("double"))


def history_scan(
    docs: DataFrame, ts: str, raw: str, now: Column, horizon: str, extra: Column | None = None
) -> DataFrame:
    """Raw messages no older than ``horizon`` before ``now``, oldest first, empty ones skipped."""
    kept = docs.filter((F.col(ts) >= now - F.expr(f"INTERVAL {horizon}")) & F.col(raw).isNotNull())
    if extra is not None:
        kept = kept.filter(extra)
    return kept.orderBy(ts)


def labelled_vectors(df: DataFrame, features: list[str], label: str | None = None, dummy: float = 0.0) -> DataFrame:
    """(features, label) rows from numeric columns; unlabelled data gets a dummy label."""
    from pyspark.ml.feature import VectorAssembler

    target = F.col(label).cast("double") if label else F.lit(dummy)
    typed = df.withColumns({c: F.col(c).cast("double") for c in features}).withColumn("_label", target)
    return VectorAssembler(inputCols=features, outputCol="features").transform(typed).select(
        "features", F.col("_label").alias("label")
    )


def arrays_to_frame(spark: SparkSession, features, labels) -> DataFrame:
    """Local arrays to a (features, label) frame."""
    schema = T.StructType(
        [T.StructField("features", T.ArrayType(T.DoubleType())), T.StructField("label", T.DoubleType())]
    )
    rows = [([float(v) for v in x], float(y)) for x, y in zip(features, labels)]
    return spark.createDataFrame(rows, schema)


def vectors_to_frame(df: DataFrame, features: str, label: str, keep: list[str] = ()) -> DataFrame:
    """(keep, features, label), the last two in double, from array columns of any number type; nulls stay null.

    Converts Arrow batches where they are, for any number of rows.
    """
    import pyarrow as pa

    def convert(batches):
        for batch in batches:
            x, y = (c.cast(t) for c, t in zip(batch.columns[-2:], (pa.list_(pa.float64()), pa.float64())))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], x, y], names=[*keep, "features", "label"])

    rows = df.select(*keep, F.col(features).alias("features"), F.col(label).alias("label"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-2]]
    return rows.mapInArrow(convert, ", ".join([*fields, "features array<double>", "label double"]))


def feature_label_pairs(
    df: DataFrame, features_col: str = "features", label_col: str = "label", classes: int | None = None
) -> DataFrame:
    """Project to (features, label) with arbitrary column names, label one-hot when asked."""
    from flowguard.functions.scalar import one_hot

    label = F.col(label_col)
    return df.select(
        F.col(features_col).alias("features"), (one_hot(label, classes) if classes else label).alias("label")
    )


def renamed_by_sql(df: DataFrame, names: dict[str, str], target: str, condition: str = "true") -> DataFrame:
    """SQL over a temporary view with column names known at run time only.

    ``target`` and ``condition`` are expressions in which ``{old name}`` stands for the quoted column; the last entry of
    ``names`` names the target.
    """
    quote = {old: "`" + old.replace("`", "``") + "`" for old in names}
    view = f"rows_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    *plain, last = names
    columns = [f"{quote[old]} AS `{names[old]}`" for old in plain] + [f"{target.format(**quote)} AS `{names[last]}`"]
    try:
        return df.sparkSession.sql(f"SELECT {', '.join(columns)} FROM {view} WHERE {condition.format(**quote)}")
    finally:
        df.sparkSession.catalog.dropTempView(view)
