import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowguard.llm import phrases as P


def brute(rows, least, longest, top, inside):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    f = Counter()
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            lang = "und" if lang is None else lang
            f[(lang, ())] += len(words)
            for i in range(len(words)):
                for k in range(1, longest + 1):
                    if i + k <= len(words):
                        f[(lang, tuple(words[i : i + k]))] += 1
    out = []
    cand = {key: n for key, n in f.items() if len(key[1]) > 1 and n >= least}
    for (lang, w), a in cand.items():
        cuts = [(10**6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
        score, _, l, r = min(cuts)
        held = any(m > len(w) and 100 * n >= inside * a for (la, v), n in cand.items() if la == lang and (m := len(v)) > len(w)
                   and any(v[i : i + len(w)] == w for i in range(m - len(w) + 1)))
        if not held:
            out.append((lang, -score, -a, " ".join(w).encode(), l, r))
    done, rank = [], Counter()
    for lang, score, a, phrase, l, r in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            done.append((lang, rank[lang], phrase.decode(), -a, l, r, f[(lang, ())], -score))
    return done


def frame(spark, rows):
    return spark.createDataFrame([(t, la, 1, "x", 2, "y", 3, 4) for t, la in rows], "text string, lang string, f int, phrase string, n int, words string, rank int, salt int")


def answer(spark, rows, **kw):
    return sorted(map(tuple, P.collocations(frame(spark, rows), "text", "lang", **kw).collect()))


def texts(seed, count, hot=0):
    rng = random.Random(seed)
    vocab = ["a", "B", "été", "日本", "x'y", "d-e", "\x00z", "und", "q" * 40, "ÀB"]
    rows = []
    for i in range(count):
        words = [rng.choice(vocab) for _ in range(rng.choice([0, 1, 2, 30]))]
        if rng.random() < 0.5:
            words += ["New", "york", "city"] * rng.choice([1, 2])
        text = "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ".", ", ", "\n", "\x0b"]) for w in words)
        rows.append((text, rng.choice(["en", "en", "en", "fr", None, "und", ""])))
    rows += [("hot pair " + rng.choice(vocab) + " tail", "en") for _ in range(hot)]
    return rows


@pytest.mark.parametrize("longest", [2, 3, 5])
def test_equal_to_counting_everything(spark, longest, monkeypatch):
    monkeypatch.setattr(P, "CHUNK_BYTES", 3000)
    monkeypatch.setattr(P, "BUCKET_WORDS", 700)
    rows = texts(1, 400, hot=800) + [(None, "en"), ("", "fr"), (None, None), ("Word " * 3000, "de")] + texts(2, 3) * 4
    got = answer(spark, rows, least=5, longest=longest, top=40, inside=50)
    assert got == sorted(brute(rows, 5, longest, 40, 50)) and len({g[0] for g in got}) > 3


def test_hot_pairs_are_found_and_dealt_by_all_words(spark, monkeypatch):
    monkeypatch.setattr(P, "BUCKET_WORDS", 700)
    rows = texts(3, 100, hot=800)
    own = frame(spark, rows).select("text", "lang")
    total, hot = P.hot_pairs(own)
    assert total == sum(len([w for w in re.split(r"[ \t.,;:!?\x0a-\x0d]+", t) if w]) for t, _ in rows) and len(hot) >= 1
    sent = P.packed(own, hot, 50, 3).collect()
    assert max(r["n"] for r in sent) < 100


def test_empty_tables(spark):
    for rows in ([], [(None, None)], [("", "en")], [("one two", "en")], [(".,;", "en")]):
        out = P.collocations(frame(spark, rows), "text", "lang")
        assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and out.collect() == []


def test_quicksort_partitions_and_abandons():
    rng = np.random.default_rng(0)
    columns, weight = [rng.integers(0, 6, 3000), rng.integers(-1, 9, 3000), rng.integers(0, 4, 3000)], rng.integers(1, 5, 3000)
    columns[2][columns[1] < 0] = -1
    want, visited = Counter(), []
    for a, b, c, w in zip(*(x.tolist() for x in columns), weight.tolist()):
        want[(a,)] += w
        want[(a, b)] += w
        if b >= 0:
            want[(a, b, c)] += w
    got = {}
    for depth, row, value, total in P.quicksort(columns, weight, 60):
        visited.append(len(row))
        for d, r, v, t in zip(depth, row, value, total):
            key = tuple(int(columns[j][r]) for j in range(d + 1))
            assert key[-1] == v and key not in got
            got[key] = int(t)
    assert got == {k: n for k, n in want.items() if n >= 60}
    assert list(P.quicksort([np.zeros(0, np.int64)], np.zeros(0, np.int64), 1)) == []
    equal = list(P.quicksort([np.zeros(500, np.int64)] * 4, np.ones(500, np.int64), 1))
    assert len(equal) == 4  # rows of one kind need a round per column


def test_words_and_rooms():
    data = b"Ab c. d\te\nF" + b"" + b"g h i j"
    words = P.Words(np.frombuffer(data, np.uint8), np.array([0, 11, 11, 18]), np.array([0, 1, 2]), 3)
    spelled = [words.vocab[i].as_py() for i in words.word]
    assert spelled == [b"ab", b"c", b"d", b"e", b"f", b"g", b"h", b"i", b"j"]
    assert words.room.tolist() == [2, 1, 2, 1, 1, 3, 3, 2, 1] and words.lang.tolist() == [0] * 5 + [2] * 4


def test_scores_are_exact_beyond_64_bits(spark):
    cases = [(10**12, 10**12 + 7, 3 * 10**12), (10**15 + 3, 10**15 + 5, 10**15 + 9), (7, 7, 7), (10, 33, 97)]
    row = spark.range(1).select(*[P.cut_score(*[F.lit(v).cast("long") for v in c]).alias(f"s{i}") for i, c in enumerate(cases)]).first()
    assert list(row) == [10**6 * a * a // (l * r) for a, l, r in cases]


def test_packing_folds_equal_suffixes():
    batch = pa.RecordBatch.from_arrays([pa.array(["a b c " * 500, "a b c"]), pa.array(["en", None])], names=["text", "lang"])
    (words, langs), = P.word_chunks(iter([batch]), 3)
    columns, weight, whole, _ = P.phrase_rows(words, words.codes(langs), np.zeros(0, P.U), 3)
    assert langs == ["en", "und"] and len(weight) < 20 and weight[~whole].sum() == (words.room > 1).sum()
