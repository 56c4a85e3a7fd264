"""Stored tables leave nothing else behind."""

from pyspark.sql import functions as F

from flowguard import session


def test_shuffles_behind_a_stored_table_are_deleted(spark):
    known = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {x for x in known.getAllFiles().mkString("|").split("|") if "shuffle_" in x and x.endswith(".data")}
    before, usual = files(), spark.conf.get(session.CLEANUP, None)
    rows = spark.range(0, 2000, 1, 4).withColumn("k", F.col("id") % 100)
    stored = session.checkpointed(rows.groupBy("k").agg(F.sum("id").alias("s")))
    assert files() <= before
    assert stored.agg(F.sum("s"), F.count("*")).first() == (1999000, 100)
    assert spark.conf.get(session.CLEANUP, None) == usual


def test_two_views_keep_no_table_of_their_fit(spark, tmp_path):
    """Fit leaves no table, scoring only the one that it still reads."""
    import os

    from flowguard.plans.suite.base import Tables
    from flowguard.plans.two_view import TwoView
    from flowguard.sources.parse import parse_flow

    session.ensure_checkpoint_dir(spark)
    folder = spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:")
    tables = lambda: {x for x in os.listdir(folder) if x.startswith("table-")}
    flows = parse_flow(Tables(spark, "/root/testdata/sf0.001").messages(71), 71, keep=["id"])
    before = tables()
    model = TwoView.fit(flows, ["...APRS.", "........", ".A...S.."], hidden=(8,), epochs=1, workers=2)
    assert tables() == before
    scored = model.score(flows)
    kept = tables() - before
    assert scored.count() > 0 and len(kept) <= 3
