import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowguard.llm import language as L

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return L.train(docs.filter(~L.held_out(F.col("doc_id"))).select("text", "lang"))


def test_held_out_accuracy(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = L.op5_mixture_language(spark, FOLDER).collect()
    assert len(rows) == len(lang) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    out = [r for r in rows if r["held_out"]]
    assert len(out) > 200 and np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in out]) > 0.97


def test_counts_equal_a_plain_count(spark):
    texts = [("Ab c", "x"), ("é1a", "y"), ("abc", None), (None, "x"), ("ab", "x"), ("", "y")]
    model = L.train(spark.createDataFrame(texts, "text string, lang string"))
    want = {}
    for text, lang in texts:
        b = " ".join("".join(chr(c) if 97 <= c < 123 or c > 127 else " " for c in (text or "").lower().encode()).split(" ")).encode("latin1")
        b = b" " + b + b" "
        for i in range(1, len(b) - 1):
            if b[i] != 32 and lang:
                cell = ((b[i - 1] << 16 | b[i] << 8 | b[i + 1]) * 0x9E3779B1 % 2**32) >> (32 - L.CELL_BITS)
                want[lang, cell] = want.get((lang, cell), 0) + 1
    assert model.languages == ["x", "y"]
    for j, lang in enumerate(model.languages):
        total = sum(n for (name, _), n in want.items() if name == lang) + L.SMOOTHING * 2**L.CELL_BITS
        for (name, cell), n in want.items():
            if name == lang:
                assert abs(model.logp[cell, j] - np.log((n + L.SMOOTHING) / total)) < 1e-4


def test_mixture_of_two_languages(spark, model):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    pick = lambda lang: " ".join(r["text"] for r in docs.filter((F.col("lang") == lang) & (F.length("text") > 2000)).limit(3).collect()).split()
    text = " ".join(pick("fr")[:300] + pick("de")[:150])
    row = L.detect(spark.createDataFrame([(text, "a", 1.0)], "text string, lang_pred string, score double"), model).first()
    assert row["lang_pred"] == "fr" and 0.55 < row["score"] < 0.8


def test_em_finds_the_proportions():
    rng = np.random.default_rng(0)
    like = np.where(np.eye(3, dtype=bool)[rng.choice(3, 600, p=[0.5, 0.3, 0.2])], -1.0, -9.0)
    lead, share = L.mixture(like)
    assert lead == 0 and abs(share - 0.5) < 0.06
    one = np.where(np.eye(2, dtype=bool)[np.r_[np.zeros(50, int), 1]], -1.0, -3.0)
    assert L.mixture(one) == (0, 1.0)  # one odd word is no second language


def test_odd_texts(spark, model):
    rows = [(None,), ("",), ("123 !? \n",), ("…—€",), ("日本語",), ("The and of " * 40_000,), ("the",)]
    got = [(r["lang_pred"], r["score"]) for r in L.detect(spark.createDataFrame(rows, "text string").coalesce(1), model).collect()]
    assert got[:4] == [("und", 0.0)] * 4 and got[4][0] != "und" and got[5][0] == "en" and got[6][0] in model.languages


def test_nothing_learned_and_empty_table(spark):
    model = L.train(spark.createDataFrame([("a", None)], "text string, lang string"))
    got = L.detect(spark.createDataFrame([("some text",)], "text string"), model).first()
    assert (got["lang_pred"], got["score"]) == ("und", 0.0)
    assert L.detect(spark.createDataFrame([], "text string"), model).count() == 0


def test_predictions_equal_fitting_every_text(spark, model):
    """The bound that settles a text without EM never changes an answer: texts one by one, whole mixtures, long and tiny ones."""
    texts = [r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("text").collect()]
    some = [t for t in texts if t][:300]
    some += [a[:300] + " " + b[-300:] for a, b in zip(some[::2], some[1::2])] + [t[:25] for t in some[:60]] + ["a", "été", " ".join(some)[:200_000]]
    rows = spark.createDataFrame(list(enumerate(some)), "i int, text string")
    got = {r["i"]: (r["lang_pred"], r["score"]) for r in L.detect(rows, model).collect()}
    mixtures = 0
    for i, text in enumerate(some):
        data = np.frombuffer(text.encode(), np.uint8)
        like, _ = model.words(data, np.array([0, len(data)]))
        if not len(like) or not L.has_letters(text):
            assert got[i] == (L.UNKNOWN, 0.0)
            continue
        best, share = L.mixture(like.astype(np.float64))
        mixtures += share < 1
        assert got[i][0] == model.languages[best] and got[i][1] == pytest.approx(share, abs=1e-6), (i, text[:50])
    assert mixtures > 20


def test_odd_rows_names_and_limits(spark, model):
    rows = spark.createDataFrame([(None, 1, 2, "x"), ("", 1, 2, "x"), ("12 !?", 1, 2, "x"), ("the house is here", 1, 2, "x"), ("the house is here", 1, 2, "x")],
                                 "text string, _guess int, score int, lang_pred string")
    got = L.detect(rows, model)
    assert got.columns == ["text", "_guess", "lang_pred", "score"]
    found = [tuple(r) for r in got.collect()]
    assert [f[2:] for f in found[:3]] == [("und", 0.0)] * 3 and all(f[1] == 1 for f in found) and found[3] == found[4]
    assert L.detect(rows.limit(0), model).collect() == []
    with pytest.raises(ValueError):
        L.train(spark.range(L.MAX_LANGUAGES + 1).select(F.lit("x").alias("text"), F.col("id").cast("string").alias("lang")))
