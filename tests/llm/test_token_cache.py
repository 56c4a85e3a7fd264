import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from flowguard.llm import token_cache as C

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, digest string, n_tokens int"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def size(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def test_fast_counts_equal_the_library(library):
    counter = C.Counter(open(PATH, "rb").read())
    assert counter.fast is not None
    rng = random.Random(5)
    signs = [chr(i) for i in range(0x250)]
    texts = ["".join(rng.choices(signs, k=rng.randint(1, 60))) for _ in range(3000)]
    texts += ["".join(rng.choices(" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0a1.'", k=rng.randint(1, 40))) for _ in range(3000)]
    texts += [c * n for c in signs for n in (1, 2, 5)] + [f"a{c}b {c}{c} 1{c}" for c in signs]
    texts += ["", "<|endoftext|>", "a<|endoftext|><|endoftext|> b ", "<|endof", "don't we'LL", "x" * 5000, "日本語 текст emoji 🎉 ½²", " 　 a"]
    for text in texts:
        assert counter.count(text) == size(library, text), repr(text)


@pytest.mark.parametrize("name", ["word_bpe_49k.json"])
def test_other_vocabularies_use_the_library(name):
    counter = C.Counter(open(public_tokenizers.path(name), "rb").read())
    other = Tokenizer.from_file(public_tokenizers.path(name))
    assert counter.fast is None and counter.count("Some WORDS here, 12") == size(other, "Some WORDS here, 12")


def test_only_distinct_misses_are_encoded(spark, tmp_path, library):
    rows = [(i, f"text number {i % 5}", "d", 1) for i in range(40)] + [(100, None, "d", 1), (101, "", "d", 1), (None, "no id", "d", 1), (None, "no id", "d", 1), (7, "other text", "d", 1)]
    cache = str(tmp_path / "cache")
    frame = spark.createDataFrame(rows, SCHEMA)
    for _ in range(2):
        got = C.count_tokens(frame, PATH, cache)
        assert got.columns == ["doc_id", "n_bytes", "n_tokens"]
        want = [(d, len((t or "").encode()), size(library, t or "")) for d, t, *_ in rows]
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
        assert spark.read.parquet(cache).count() == 8  # 5 texts, the empty one, two more; the second run adds none
    C.count_tokens(spark.createDataFrame([(1, "brand new", "", 0), (2, "text number 1", "", 0)], SCHEMA), PATH, cache).collect()
    assert spark.read.parquet(cache).count() == 9
    C.count_tokens(frame, public_tokenizers.path("word_bpe_49k.json"), cache).collect()
    assert spark.read.parquet(cache).count() == 17


def test_empty_table(spark, tmp_path):
    assert C.count_tokens(spark.createDataFrame([], SCHEMA), PATH, str(tmp_path / "c")).count() == 0


def test_query_over_whole_texts(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = C.op9_digest_cache(spark, folder).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows} == {
        d: (len(t.encode()), size(library, t), size(library, t) > 1024) for d, t in texts.items()}
