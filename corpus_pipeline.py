"""A training corpus from raw documents: language, near-duplicates, benchmark passages, mixture, shards.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet and read again for the next one.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.llm import decontaminate, jaccard, language, mixing, sharding
from flowguard.llm.registry import table
from flowguard.llm.tables import Stored


#: Texts are long: batches of so many rows keep Arrow buffers of executors and their Python workers at a few MB.
BATCH_ROWS = "1000"


def short_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language, with that language as ``lang``: those without text or letters go."""
    short_batches(spark)
    taught = docs.filter(~language.held_out(F.col("doc_id"))).select("text", "lang")
    guessed = language.detect(docs, language.train(taught))
    known = guessed.filter(F.col("lang_pred") != language.UNKNOWN)
    return known.select(*[F.col("lang_pred").alias(c) if c == "lang" else F.col(f"`{c}`") for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    short_batches(spark)
    return jaccard.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    short_batches(spark)
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that every source has the same expected size, in a shuffled order."""
    return mixing.mix_sources(docs).select(*docs.columns)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot."""
    return sharding.shard_rows(docs, ["doc_id"])


STAGES = [
    ("language ID", known_language),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources to target weights", mixed_sources),
    ("sharding", sharded),
]

#: Stages learn a model, compare sets and align texts: SQL cannot express them. Tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = Stored(stage(spark, docs, sf_dir), name.replace(" ", "-")).df
    return STAGES[-1][1](spark, docs, sf_dir)
