"""Registry of checked queries and the views they share over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Driver tables and derived views of one scale-factor folder."""

    def __init__(self, spark: SparkSession, folder: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.folder = spark, folder

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def flow(self, per: int = 1) -> DataFrame:
        """Flow view of ``events``; ``per`` coarsens the clock for denser windows."""
        sec = F.unix_timestamp(F.col("ts").cast("timestamp"))
        return self("events").select(
            F.col("event_id").alias("id"),
            F.floor(sec / per).cast("bigint").alias("sec"),
            F.col("user_id").alias("sa"),
            (F.col("event_id") % 50).alias("da"),
            (1024 + F.col("event_id") % 977).alias("sp"),
            (F.length("event_type") * 100).cast("bigint").alias("dp"),
            F.col("event_type").alias("pr"),
            F.col("value").alias("td"),
            F.get_json_object("props", "$.k").try_cast("bigint").alias("ipkt"),
            F.floor(F.col("value") * 100).cast("bigint").alias("ibyt"),
            (F.col("event_id") % 5).alias("stos"),
        )

    def edge(self, slot_len: int = 3600) -> DataFrame:
        """Edges of the event stream in arrival order, with hourly slots by default."""
        from flowguard.operators.edges import with_slots

        flow = self.flow().select(F.col("id").alias("seq"), F.col("sa").alias("src"), F.col("da").alias("dst"), "sec")
        return with_slots(flow, "sec", slot_len, "seq")

    def messages(self, width: int = 48) -> DataFrame:
        """Events as CSV flow messages: (id, value)."""
        fields = [
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
            F.floor(F.col("value") * 100).cast("bigint").cast("string"),
            F.concat(
                F.lit("10.0."), F.floor(F.col("user_id") / 256).cast("string"), F.lit("."), (F.col("user_id") % 256).cast("string")
            ),
            F.concat(F.lit("10.1.0."), (F.col("event_id") % 50).cast("string")),
            (1024 + F.col("event_id") % 977).cast("string"),
            (F.length("event_type") * 100).cast("string"),
            F.upper("event_type"),
            F.lit("...APRS."),
            F.lit("0"),
            (F.col("event_id") % 5).cast("string"),
            F.get_json_object("props", "$.k"),
            F.floor(F.col("value") * 100).cast("bigint").cast("string"),
        ]
        fields.append(F.lit(",".join(["0"] * 35)))
        if width == 71:
            fields.append(F.lit("ShADadFf"))
            fields.append(F.lit(",".join(["0"] * 22)))
        return self("events").select(F.col("event_id").alias("id"), "event_type", F.concat_ws(",", *fields).alias("value"))

    def results(self) -> DataFrame:
        """Detector results: (key, module, score, is_anomalous, features, arrival, sa)."""
        module = F.element_at(
            F.create_map(*[F.lit(x) for pair in MODULE_OF.items() for x in pair]), F.col("event_type")
        )
        return self("events").select(
            F.concat(F.col("user_id").cast("string"), F.lit("|"), F.date_format("ts", "yyyy-MM-dd")).alias("key"),
            module.alias("module"),
            F.col("value").alias("score"),
            (F.col("value") > 100).alias("is_anomalous"),
            F.concat(F.lit("f"), F.col("event_id").cast("string")).alias("features"),
            F.col("event_id").alias("arrival"),
            F.col("user_id").alias("sa"),
        )

    def scored(self, label: str = "quality") -> DataFrame:
        return self("labels").join(self("documents").select("doc_id", "n_chars", "lang"), "doc_id").select(
            "doc_id", F.col("n_chars").cast("double").alias("score"), F.col(label).alias("label"), "lang"
        )

    def vectors(self) -> DataFrame:
        return self("embeddings").select(
            F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("x"), "label"
        )

    def lines(self) -> DataFrame:
        """Events as syslog lines."""
        return self("events").select(
            F.col("event_id").alias("id"),
            F.concat(
                F.date_format("ts", "MMM dd HH:mm:ss"), F.lit(" host"), F.col("user_id").cast("string"), F.lit(" "),
                F.when(F.col("event_id") % 3 == 0, F.concat("event_type", F.lit("["), F.get_json_object("props", "$.k"), F.lit("]")))
                .when(F.col("event_id") % 3 == 1, F.col("event_type")).otherwise(""),
                F.lit(": event number "), F.col("event_id").cast("string"),
            ).alias("line"),
        )


MODULE_OF = {"click": "MIDAS", "error": "IFOREST", "purchase": "AE", "signup": "GANomaly", "view": "ZEEKFLOW"}


def flow_sql(per: int = 1) -> str:
    return f"""flow AS (SELECT event_id AS id, CAST(floor(CAST(floor(epoch(ts)) AS BIGINT) / {per}) AS BIGINT) AS sec,
      user_id AS sa, event_id % 50 AS da, 1024 + event_id % 977 AS sp, CAST(length(event_type) * 100 AS BIGINT) AS dp,
      event_type AS pr, value AS td, CAST(json_extract_string(props, '$.k') AS BIGINT) AS ipkt,
      CAST(floor(value * 100) AS BIGINT) AS ibyt, event_id % 5 AS stos FROM events)"""


EDGE_SQL = flow_sql() + """, edge AS (SELECT id AS seq, sa AS src, da AS dst, sec,
      CAST(floor((sec - (SELECT arg_min(sec, id) FROM flow)) / 3600) AS BIGINT) + 1 AS slot FROM flow)"""

FLOW_CSV = """strftime(ts, '%Y-%m-%d %H:%M:%S') || ',' || strftime(ts, '%Y-%m-%d %H:%M:%S') || ','
      || CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) || ',10.0.' || CAST(user_id // 256 AS VARCHAR) || '.'
      || CAST(user_id % 256 AS VARCHAR) || ',10.1.0.' || CAST(event_id % 50 AS VARCHAR) || ','
      || CAST(1024 + event_id % 977 AS VARCHAR) || ',' || CAST(length(event_type) * 100 AS VARCHAR) || ','
      || upper(event_type) || ',...APRS.,0,' || CAST(event_id % 5 AS VARCHAR) || ','
      || json_extract_string(props, '$.k') || ',' || CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR)
      || repeat(',0', 35)"""

RESULTS_SQL = """results AS (SELECT CAST(user_id AS VARCHAR) || '|' || strftime(ts, '%Y-%m-%d') AS key,
      CASE event_type WHEN 'click' THEN 'MIDAS' WHEN 'error' THEN 'IFOREST' WHEN 'purchase' THEN 'AE'
        WHEN 'signup' THEN 'GANomaly' ELSE 'ZEEKFLOW' END AS module,
      value AS score, value > 100 AS is_anomalous, 'f' || CAST(event_id AS VARCHAR) AS features, event_id AS arrival,
      user_id AS sa FROM events)"""

SCORED_SQL = """scored AS (SELECT l.doc_id, CAST(d.n_chars AS DOUBLE) AS score, l.quality AS label, d.lang
      FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""

VECTORS_SQL = "vectors AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x, label FROM embeddings)"


def query(name: str, sql: str | None = None):
    """Register a query of (tables) under a name, with the SQL that must give the same rows."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql:
            ORACLES[name] = sql
        return build

    return register
