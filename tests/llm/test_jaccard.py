import random
import re

import pyarrow as pa
import pytest

from flowguard.llm import jaccard as J
from flowguard.llm.components import components
from flowguard.llm.grams import U, shingle_sets, text_buffers

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    by = {}
    for i, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(i)
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, s in enumerate(sets):
        if rows[i][0] is None:
            continue
        both = {}
        for x in s:
            for j in by[x]:
                if j < i and rows[j][0] is not None:
                    both[j] = both.get(j, 0) + 1
        for j, n in both.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                up[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    return sorted([(d, len(sets[i]), None if d is None else low[root(i)]) for i, (d, _) in enumerate(rows)], key=str)


def found(spark, rows, parts=5):
    frame = spark.createDataFrame([(d, t, 1, "c") for d, t in rows], "doc_id long, text string, n int, class string").repartition(parts)
    return sorted(map(tuple, J.near_duplicates(frame).collect()), key=str)


def edited(rng, words, share):
    return [rng.choice(["new", "other", "word"]) + str(rng.randint(0, 99)) if rng.random() < share else w for w in words]


def corpus(seed, groups=12, size=12):
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randint(0, 3000)}" for _ in range(n)]
    passage = fresh(55)
    rows, doc = [], 1000
    for _ in range(groups):
        base = fresh(rng.choice([4, 5, 6, 9, 30, 120, 400]))
        for _ in range(rng.randint(1, size)):
            words = edited(rng, base, rng.choice([0, 0.005, 0.02, 0.04]))
            if rng.random() < 0.3:
                words = words[: rng.randint(1, len(words))]
            if rng.random() < 0.3:
                words += passage
            rows.append((doc, " ".join(words).upper() if rng.random() < 0.1 else "\n".join(words)))
            doc += rng.randint(1, 5)
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equal_to_all_pairs(spark, seed):
    rows = corpus(seed) + [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "two words"), (None, "one"), (None, None), (4, "two words"), (4, "one")]
    assert found(spark, rows) == brute(rows)


def test_small_blocks_chains_and_split_lists(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_TOKENS", 700)
    monkeypatch.setattr(J, "HOT_LIST", 3)
    rng = random.Random(9)
    words = [f"c{i}" for i in range(100)]
    chain = []
    for i in range(60):  # each links with its neighbours only
        chain.append((i, " ".join(words)))
        at = rng.randint(0, 95)
        words[at : at + 3] = [f"n{i}a", f"n{i}b", f"n{i}c"]
    near = [(500 + i, " ".join(edited(rng, [f"b{k}" for k in range(300)], 0.01))) for i in range(80)]
    rows = chain + near + corpus(4)
    assert found(spark, rows, 9) == brute(rows)


def test_production_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    want = brute([(r[0], r[1]) for r in docs])
    got = sorted(map(tuple, J.op6_token_group_join(spark, "/root/testdata/sf0.01").collect()), key=str)
    assert got == want and len({c for *_, c in want}) < len(want)


def test_empty_table_and_no_links(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, "a b c d e f"), (2, "g h i j k l")]) == [(1, 2, 1), (2, 2, 2)]


def test_one_of_each_group_stays(spark):
    rows = [(3, "a b c d e f"), (1, "a b c d e f"), (2, "x y z u v w"), (4, None), (4, None), (2, "x y z u v w"), (None, "a b c d e f")]
    kept = J.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r[0] or 0, r[1] or "") for r in kept.collect()) == [(0, "a b c d e f"), (1, "a b c d e f"), (2, "x y z u v w"), (4, ""), (4, "")]


def test_components_of_random_graphs(spark):
    rng = random.Random(7)
    edges = [(rng.getrandbits(40), rng.getrandbits(40)) for _ in range(50)]
    path = [rng.getrandbits(40) for _ in range(300)]
    edges += list(zip(path, path[1:])) + [(path[0], path[0])] + [(path[5], rng.getrandbits(40)) for _ in range(200)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert len({got[x] for x in path}) == 1 and all(got[a] == got[b] for a, b in edges)
    assert len(set(got.values())) == 51
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_link_at_a_size_next_to_the_largest_of_a_group(spark, monkeypatch):
    """A (101 shingles) links with B (124) but not with C (125), which lies in the same group; own shingles come first."""
    base = [f"s{k}" for k in range(105)]
    a = " ".join(base)
    b = " ".join(base[:104] + [f"b{k}" for k in range(24)])
    c = " ".join(base[:104] + [f"c{k}" for k in range(25)])
    sizes = [len(shingles(x)) for x in (a, b, c)]
    assert sizes == [101, 124, 125]

    def steered(docs, sketch):
        """Shingles of B and C only come before those of all three."""
        for own in set(map(J_key, shingles(b))) ^ set(map(J_key, shingles(c))):
            sketch[own] = 0
        return tokens(docs, sketch)

    def J_key(words):
        data, offsets = text_buffers(pa.array([" ".join(words)], pa.large_string()))
        return int(next(shingle_sets(data, offsets, 5))[0] >> U(64 - J.SKETCH_BITS))

    tokens = J.prefix_tokens
    monkeypatch.setattr(J, "prefix_tokens", steered)
    rows = [(1, a), (2, b), (3, c)]
    assert found(spark, rows) == brute(rows)


def test_bound_holds_at_every_size(spark):
    """Classes at sizes 5k - 1 and 5k around a query: it is opened to every group that holds a member it may link with."""
    rng = random.Random(11)
    behind = lambda n: (4 * n + 4) // 5 - 1
    rows, want = [], set()
    for g in range(200):
        n = rng.randint(10, 200)
        top = rng.choice([s for s in range(n, 5 * n // 4 + 1) if s % 5 == 0] or [n])
        members = [rng.randint(-(-4 * n // 5), top), top - 1, top] if 5 * (top - 1) >= 4 * n else [top]
        need = lambda s: -(-4 * (n + s) // 9) - max(behind(n), behind(s))
        x = max(1, min(need(s) for s in range(min(members), top + 1)))
        for token in range(x):
            rows += [(1000 * g + token, 10 * g + 1, n, 10 * g)] + [(1000 * g + token, 10 * g + 2 + j, m, 10 * g + 5) for j, m in enumerate(members)]
        want.add(10 * g + 1)
    pairs = J.matrix_pairs(spark.createDataFrame(rows, "token long, class long, n int, group long"))
    assert {r["class"] for r in pairs.collect() if r["class"] % 10 == 1} == want


def test_keep_one_leaves_any_column_names(spark):
    names = ["_id", "_c", "_n", "_k", "_least", "_place", "n_shingles", "component_id", "class", "rep"]
    rows = spark.createDataFrame([(i, f"one two three four five {i // 2}", *range(10)) for i in range(6)], f"doc_id long, text string, {', '.join(f'{n} int' for n in names)}")
    kept = J.keep_one(rows)
    assert kept.columns == rows.columns and sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 4]
    assert all(tuple(r)[2:] == tuple(range(10)) for r in kept.collect())
