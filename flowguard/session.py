"""Session settings and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "flowguard", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine assumes (UTC clock, AQE with skew joins)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by the session; a local temporary one only in local mode."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="flowguard-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")


_owner: ContextVar[list[str] | None] = ContextVar("owner of intermediate tables", default=None)


@contextmanager
def temporary_tables(spark: SparkSession):
    """Tables that ``checkpointed`` writes inside are deleted at the end: for jobs that have written what they are for by then,
    such as a micro-batch. Nested owners delete their own."""
    paths: list[str] = []
    token = _owner.set(paths)
    try:
        yield paths
    finally:
        _owner.reset(token)
        for path in paths:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write the frame once as a table in the shared checkpoint folder and continue from it.

    A columnar table is smaller than checkpointed rows, and later reads take only the columns
    they need. Lost executors cost a re-read, not the lineage in front of it. The table stays until its
    ``temporary_tables`` block ends; outside of one it belongs to whoever reads the result. Shuffle files behind it go as soon
    as it is written: else they stay until the driver collects its garbage, beside those of all later steps.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/table-{uuid.uuid4().hex}"
    if (owner := _owner.get()) is not None:
        owner.append(path)
    usual = spark.conf.get(CLEANUP, None)
    try:
        spark.conf.set(CLEANUP, "true")
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if usual is None else spark.conf.set(CLEANUP, usual)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``checkpointed`` that no later step reads."""
    for table in tables:
        target = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        target.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


def scan_parallelism(spark: SparkSession) -> int:
    """Number of range partitions for ordered scans."""
    return max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        spark.sparkContext.defaultParallelism,
    )
