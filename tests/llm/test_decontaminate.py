import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowguard.llm import decontaminate as D

SCHEMA = "doc_id long, text string, item_id string, _found int"


def plain_align(a, b):
    """Smith-Waterman cell by cell."""
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            table[i, j] = max(0, table[i - 1, j - 1] + (D.MATCH if a[i - 1] == b[j - 1] else D.MISMATCH), table[i - 1, j] - D.GAP, table[i, j - 1] - D.GAP)
    return table.max()


def test_alignment_equals_the_plain_table():
    rng = np.random.default_rng(4)
    for _ in range(60):
        a, b = (rng.integers(0, 5, rng.integers(1, 25)).astype(np.uint64) for _ in range(2))
        assert D.align(a, b)[0] == plain_align(a, b)
    assert D.align(np.zeros(0, np.uint64), np.ones(3, np.uint64)) == (0, 0) == D.align(np.ones(3, np.uint64), np.zeros(0, np.uint64))


def runs(text):
    w = text.lower().split()
    return {tuple(w[i : i + D.SEED_WORDS]) for i in range(len(w))}


def brute(docs, items):
    """Best alignment of every item with every whole document."""
    out = set()
    code = {}
    enc = lambda t: np.array([code.setdefault(w, len(code)) for w in (t or "").lower().split()], np.uint64)
    for i, text in items:
        a = enc(text)
        if len(a) < D.SEED_WORDS:
            continue
        for d, body in docs:
            if D.align(a, enc(body))[0] >= D.MIN_SCORE * D.MATCH * len(a):
                out.add((d, i))
    return out


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(8)
    word = lambda: f"v{int(3000 ** rng.random())}"
    text = lambda n: [word() for _ in range(n)]
    items = [(i, " ".join(text(rng.randint(14, 60)))) for i in range(30)]
    docs, line = [], text(60)
    for d in range(300):
        body = text(rng.randint(5, 300))
        if d % 3 == 0:
            words = items[d % 30][1].split()
            edit = [w if rng.random() > (0, 0.1, 0.2)[d // 3 % 3] else word() for w in words]
            if d % 5 == 0:
                del edit[len(edit) // 2]
            at = rng.randint(0, len(body))
            body[at:at] = edit
        if d % 4 == 0:
            body += line
        docs.append((d, " ".join(body).upper() if d % 7 == 0 else "\n ".join(body)))
    return docs, items


def run(spark, docs, items, kind="long"):
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], SCHEMA).repartition(4)
    bench = spark.createDataFrame(items, f"item_id {kind}, text string")
    found = frame.select("doc_id", "text", F.explode(D.benchmark_matches(frame, bench)).alias("m"))
    return found.select("doc_id", "text", "m.*").collect()


def test_planted_passages_are_found_and_nothing_else(spark, planted):
    docs, items = planted
    rows = run(spark, docs, items)
    got, want = {(r["doc_id"], r["item_id"]) for r in rows}, brute(docs, items)
    assert got <= want and len(got) >= 90
    for d, i in want - got:  # what is lost has no run of words in common with the item
        assert not runs(docs[d][1]) & runs(items[i][1])
    exact = dict(items)
    for r in rows:
        assert 0.5 <= r["score"] <= 1
        part = r["text"].lower().split()[r["start_word"] : r["end_word"]]
        assert (" ".join(part) == exact[r["item_id"]]) == (r["score"] == 1)


def test_slices_change_nothing(spark, planted, monkeypatch):
    docs, items = planted
    want = sorted(map(tuple, run(spark, docs, items)))
    monkeypatch.setattr(D, "SLICE_WORDS", 400)
    assert sorted(map(tuple, run(spark, docs, items))) == want


def test_odd_rows_and_empty_tables(spark):
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    items = [("a", text), ("a", text), ("short", "one two"), (None, None), ("e", ""), (None, text + " more")]
    docs = [(1, text), (1, text), (2, None), (3, ""), (None, text), (4, "one two three"), (5, f"{text} x {text}")]
    rows = run(spark, docs, items, "string")
    got = sorted((str(r["doc_id"]), str(r["item_id"])) for r in rows)
    one = ["None", "None"]
    assert got == sorted([(d, i) for d in ("1", "1", "None", "5") for i in ("None", "a", "a")]) and one
    assert run(spark, [], items, "string") == [] == run(spark, docs, [], "string")


def test_clean_documents_keep_their_columns(spark, planted):
    docs, items = planted
    frame = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], SCHEMA)
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = D.clean_documents(frame, bench)
    assert kept.columns == frame.columns
    dirty = {r["doc_id"] for r in run(spark, docs, items)}
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in docs} - dirty


def test_query_finds_every_verbatim_item(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    items = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    fold = lambda t: " " + " ".join(re.findall("[a-z0-9\\u0080-\U0010ffff]+", t.lower())) + " "
    want = {(d["doc_id"], i["item_id"]) for d in docs for i in items if fold(i["text"]) in fold(d["text"] or "")}
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in D.op4_rare_seed_alignment(spark, folder).collect()}
    assert want and {k for k, s in got.items() if s == 1} == want


@pytest.mark.parametrize("copies", [9, 100, 1000])
def test_copies_do_not_make_their_own_seeds_common(spark, copies):
    """Every fourth word of the item is replaced; the same passage stands in many documents, one has it verbatim."""
    item = [f"i{k}" for k in range(60)]
    edit = [f"e{k}" if k % 4 == 3 else w for k, w in enumerate(item)]
    docs = [(d, " ".join([f"d{d}a", f"d{d}b", *edit, f"d{d}c"])) for d in range(copies)]
    rows = run(spark, docs, [(1, " ".join(item))])
    assert {r["doc_id"] for r in rows} == {d for d, _ in docs} and all(0.5 <= r["score"] < 1 for r in rows)
    rows = run(spark, [*docs, (-1, " ".join(item))], [(1, " ".join(item))])
    assert {r["doc_id"] for r in rows} == {d for d, _ in docs} | {-1}


def test_bounds_are_never_below_the_score(monkeypatch):
    rng = np.random.default_rng(5)
    monkeypatch.setattr(D, "WINDOW_WORDS", 90)
    items = [" ".join(f"w{k}" for k in rng.integers(0, 12, rng.integers(3, 40))) for _ in range(40)]
    seeds = D.make_seeds(list(range(40)), items)
    hashes = np.concatenate([seeds.texts[i] for i in rng.integers(0, 40, 30)])
    lo = rng.integers(0, len(hashes) - 1, 200)
    hi = np.minimum(len(hashes), lo + rng.integers(1, 120, 200))
    item = rng.integers(0, 40, 200)
    bound = D.score_bounds(seeds, hashes, item, lo, hi)
    for b, i, x, y in zip(bound, item, lo, hi):
        worth = [2 if w in set(seeds.texts[i].tolist()) else -1 for w in hashes[x:y].tolist()]
        want = now = 0
        for v in worth:
            now = max(0, now + v)
            want = max(want, now)
        assert max(b, 0) == want >= D.align(seeds.texts[i], hashes[x:y])[0]


def found_in(spark, docs, items):
    frame = spark.createDataFrame([(i, t, "x", 0) for i, t in enumerate(docs)], SCHEMA)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = frame.select("doc_id", F.explode(D.benchmark_matches(frame, bench)).alias("m")).select("doc_id", "m.item_id", "m.score").collect()
    return {(r["doc_id"], r["item_id"]): r["score"] for r in rows}


def test_long_runs_of_long_items_count(spark):
    rng = random.Random(11)
    text = lambda n: [f"w{rng.randrange(4000)}" for _ in range(n)]
    item = text(500)
    edited = [w if i % 6 else "other" for i, w in enumerate(item[100:340])]
    docs = [text(80) + item[130:370] + text(80), text(30) + edited + text(30), text(90) + item[10:50] + text(90), text(400), item]
    got = found_in(spark, [" ".join(d) for d in docs], [" ".join(item)])
    assert set(got) == {(0, 0), (1, 0), (4, 0)} and got[4, 0] == 1.0 and 0.45 < got[0, 0] < 0.5
    short = text(60)  # unchanged: half of a short item
    assert set(found_in(spark, [" ".join(text(9) + short[:33] + text(9)), " ".join(text(9) + short[:25] + text(9))], [" ".join(short)])) == {(0, 0)}


def test_scripts_without_blanks(spark):
    rng = random.Random(12)
    signs = lambda n, a, b: "".join(chr(rng.randrange(a, b)) for _ in range(n))
    han, thai, kana = signs(40, 0x4E00, 0x4F00), signs(40, 0xE01, 0xE2F), signs(40, 0x3041, 0x3090)
    docs = [signs(50, 0x4E00, 0x4F00) + han + signs(50, 0x4E00, 0x4F00), "see " + thai + " end", kana[:15] + "x" + kana[16:], signs(300, 0x4E00, 0x4F00), han[:12] + signs(60, 0x4E00, 0x4F00), "plain words only " * 9]
    assert set(found_in(spark, docs, [han, thai, kana, ""])) == {(0, 0), (1, 1), (2, 2)}


def test_words_of_mixed_scripts():
    from flowguard.llm.grams import PUNCTUATION, text_buffers, words

    texts = ["ab \u4e2d\u6587 cd", "\u4e2d", "x\u4e2dy", "\u0e01\u0e02 \u00e9t\u00e9", "", "\uac00\ub098 \u30a2"]
    import pyarrow as pa

    data, offsets = text_buffers(pa.array(texts))
    hashes, first = words(data, offsets, PUNCTUATION, singles=True)
    assert np.diff(first).tolist() == [4, 1, 3, 3, 0, 2]
    assert hashes[1] == hashes[4] == hashes[6]  # the same letter, alone or inside
    plain, begin = words(data, offsets, PUNCTUATION)
    assert np.diff(begin).tolist() == [3, 1, 1, 2, 0, 2]
