"""Wire messages to columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard.functions.scalar import parse_timestamp, utf8_or_null
from flowguard.schema import BY_WIDTH, MODULE_FEATURES, MODULES


def decode(records: DataFrame) -> DataFrame:
    """Binary value to text; undecodable values become null."""
    return records.withColumn("value", utf8_or_null(F.col("value")))


def parse_flow(df: DataFrame, width: int, value: str = "value", keep: list[str] = ()) -> DataFrame:
    """Positional CSV to named text columns; the layout is chosen by width.

    The text is split in a projection of its own, so that it is split once and not per field.
    """
    parts = df.select(*keep, F.split(value, ",").alias("_parts"))
    fields = [F.get("_parts", F.lit(i)).alias(n) for i, n in enumerate(BY_WIDTH[width])]
    return parts.select(*keep, *fields)


def message_width(value: Column) -> Column:
    return F.size(F.split(value, ","))


def split_by_width(df: DataFrame, widths=(48, 71), value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Messages of a known width, and the rest."""
    fits = F.coalesce(message_width(F.col(value)).isin(*widths), F.lit(False))
    return df.filter(fits), df.filter(~fits)


def edge_fields(value: Column) -> list[Column]:
    """Timestamp, source and destination keep their position in every layout."""
    parts = F.split(value, ",")
    return [
        parse_timestamp(F.get(parts, F.lit(0))).alias("ts"),
        F.get(parts, F.lit(3)).alias("source"),
        F.get(parts, F.lit(4)).alias("destination"),
    ]


def json_or_null(value: Column, schema: str) -> Column:
    """JSON object to a struct; text that is not an object becomes null."""
    parsed = F.from_json(value, f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    fields = [f.strip().split()[0] for f in schema.split(",")]
    good = F.struct(*[parsed.getField(f).alias(f) for f in fields])
    return F.when(parsed["_bad"].isNull() & parsed.isNotNull(), good)


def envelope_message(value: Column) -> Column:
    return F.get_json_object(value, "$.message")


def module_position(value: Column) -> Column:
    """Number of flow fields in front of the detector name, null when there is none."""
    return _module_at(F.split(value, ","))


def _module_at(parts: Column) -> Column:
    return F.when(F.get(parts, F.lit(48)).isin(*MODULES), 48).when(F.get(parts, F.lit(71)).isin(*MODULES), 71)


# Detector payload layout, "[f1,...]",score,flag.
PAYLOAD_PATTERN = r'^(?:"\[([^\]"]*)\]"|\[([^\],]*)\]),([^,]*),([^,]*)$'


def parse_payload(payload: Column, module: Column) -> Column:
    """Struct (features, score, is_anomalous); null when the feature count is not the module's."""
    features = F.concat(F.regexp_extract(payload, PAYLOAD_PATTERN, 1), F.regexp_extract(payload, PAYLOAD_PATTERN, 2))
    count = F.when(features == "", 0).otherwise(F.size(F.split(features, ",")))
    expected = reduce(
        lambda acc, m: F.when(module == m, MODULE_FEATURES[m]).otherwise(acc), MODULES, F.lit(None).cast("int")
    )
    flag = F.regexp_extract(payload, PAYLOAD_PATTERN, 4)
    fields = F.struct(
        features.alias("features"),
        F.regexp_extract(payload, PAYLOAD_PATTERN, 3).try_cast("double").alias("score"),
        (flag == "1").alias("is_anomalous"),
    )
    return F.when(payload.rlike(PAYLOAD_PATTERN) & (count == expected), fields)


def parse_results(df: DataFrame, value: str = "value", keep: list[str] = ()) -> DataFrame:
    """Detector result messages to flow fields, module, features, score and flag.

    Messages without a known module or with a malformed payload are dropped here; use
    ``module_position`` to route them elsewhere.
    """
    split = df.withColumn("_parts", F.split(value, ","))
    parts = F.col("_parts")
    typed = split.withColumn("_at", _module_at(parts)).filter("_at is not null")
    typed = typed.select(
        *keep,
        F.slice(parts, 1, F.col("_at")).alias("flow"),
        F.get(parts, F.col("_at")).alias("module"),
        F.concat_ws(",", F.slice(parts, F.col("_at") + 2, F.size(parts))).alias("_payload"),
    )
    parsed = typed.withColumn("_p", parse_payload(F.col("_payload"), F.col("module"))).filter("_p is not null")
    return parsed.select(*keep, "flow", "module", "_p.*")


def shared_flow_fields(flow: Column) -> list[Column]:
    """Flow fields every detector sees: the 48 raw ones and the 14 derived ones of wide messages."""
    raw = [F.get(flow, F.lit(i)) for i in range(48)]
    derived = [F.get(flow, F.lit(i)) for i in range(57, 71)]
    return raw + derived
