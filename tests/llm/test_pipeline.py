import zlib

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from flowguard.llm import language, sharding
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_jaccard import brute as groups
from tests.llm.test_mixing import brute as mixed

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def spoken(model, text):
    """The language that fitting the whole text by itself gives."""
    data = np.frombuffer(text.encode(), np.uint8)
    like, _ = model.words(data, np.array([0, len(data)]))
    return model.languages[language.mixture(like.astype(np.float64))[0]]


def expected(spark, docs, items):
    """The stages one after the other over lists of rows."""
    taught = spark.createDataFrame([(r[1], r[2]) for r in docs if zlib.crc32(str(r[0]).encode()) % 4 != 2], "text string, lang string")
    model = language.train(taught)
    rows = [(*r[:2], spoken(model, r[1]), *r[3:]) for r in docs if language.has_letters(r[1])]
    least = {}
    for (d, n, c), r in zip(groups([(r[0], r[1]) for r in rows]), sorted(rows, key=lambda r: str((r[0],)))):
        least[d] = (n, c)
    rows = [r for r in rows if least[r[0]][0] == 0 or least[r[0]][1] == r[0]]
    dirty = {d for d, _ in leaks([(r[0], r[1]) for r in rows], items)}
    rows = [r for r in rows if r[0] not in dirty]
    by_id = {r[0]: r for r in rows}
    copies = sorted(mixed([(r[0], r[1], r[3]) for r in rows]), key=lambda x: x[0])
    at = sharding.permute(np.arange(len(copies)), len(copies))
    return sorted((*by_id[d], int(at[i] % 24), int(at[i] // 24)) for i, (d, *_) in enumerate(copies))


def test_run_equals_the_stages_over_lists(spark):
    docs = [tuple(r[c] for c in COLUMNS) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.columns == [*COLUMNS, "shard", "slot"]
    assert sorted(map(tuple, got.collect())) == expected(spark, docs, items)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_odd_and_empty_tables(spark, name, stage):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "text without an id", "en", "b", 18), (3, "the same words", "fr", "a", 14), (3, "the same words", "fr", "a", 14), (4, "!!! 123", "en", "a", 7)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, extra int"
    for data in (rows, []):
        frame = spark.createDataFrame([(*r, 1) for r in data], schema)
        got = stage(spark, frame, FOLDER)
        assert [c for c in got.columns if c in frame.columns] == frame.columns
        n = got.count()
        assert n <= 2 * len(data) + 5 and (data or not n)


def test_language_stage_drops_texts_without_letters_only(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").union(spark.createDataFrame([(10**9, "12 34", "en", "s", 5), (10**9 + 1, None, "en", "s", 5)], "doc_id long, text string, lang string, source string, n_chars long"))
    got = corpus_pipeline.known_language(spark, docs.withColumn("lang", F.when(F.col("doc_id") % 3 > 0, F.col("lang"))), FOLDER)
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    said = {r["doc_id"]: r["lang"] for r in got.collect()}
    assert np.mean([said[d] == lang[d] for d in said]) > 0.97  # also where the input says nothing
    kept = set(said)
    assert kept == {r[0] for r in docs.filter(F.col("doc_id") < 10**9).select("doc_id").collect()}


def test_language_stage_runs_its_model_once_a_row(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    plan = corpus_pipeline.known_language(spark, docs, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
