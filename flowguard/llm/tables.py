"""Intermediate tables in the shared checkpoint folder, dropped as soon as nobody needs them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from flowguard.session import ensure_checkpoint_dir


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of this application, on storage that driver and executors share."""
    ensure_checkpoint_dir(spark)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


class Stored:
    """A frame written as Parquet: ``df`` reads it, ``drop`` deletes the files."""

    def __init__(self, df: DataFrame, name: str = "table"):
        self.spark = df.sparkSession
        self.path = new_path(self.spark, name)
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
