import random

from flowguard.llm import topk as T


def brute(queries, rows, k):
    out = []
    for qi, q in {(i, tuple(x)) for i, x in queries if i is not None and x is not None}:
        scored = [(-sum(a * b for a, b in zip(q, x)), i) for i, x in {(i, tuple(x)) for i, x in rows if i is not None and x is not None}
                  if i != qi and len(x) == len(q)]
        out += [(qi, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def answer(spark, queries, rows, k):
    frames = (spark.createDataFrame([(i, x, "z") for i, x in f], "id long, x array<long>, dim string") for f in (queries, rows))
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in T.top_k(*frames, k).collect())


def test_equal_to_all_scores(spark, monkeypatch):
    monkeypatch.setattr(T, "BLOCK_ROWS", 150)
    monkeypatch.setattr(T, "QUERY_ROWS", 7)
    rng = random.Random(1)
    rows = [(i, [rng.randint(-300, 300) for _ in range(12)]) for i in range(600)]
    rows += [(1000 + i, [5, -7] * 6) for i in range(400)]  # many equal vectors: ties by id
    rows += [(2000 + i, [0] * 12) for i in range(30)] + [(3000, [1, 2]), (3001, [3, 4]), (3002, []), (3003, []), (3004, None), (None, [1] * 12)]
    queries = [r for r in rows if r[0] is not None and r[0] % 20 == 0] + [rows[0]]
    assert answer(spark, queries, rows, 10) == brute(queries, rows, 10)


def test_few_candidates_and_empty_tables(spark):
    rows = [(0, [1, 2]), (1, [2, 1]), (1, [2, 1])]
    assert answer(spark, rows[:1], rows, 10) == [(0, 1, 1, 4)]
    assert answer(spark, [], rows, 10) == [] == answer(spark, rows, [], 10)
    assert answer(spark, rows[:1], rows[:1], 3) == []


def test_reading_stops_before_the_end():
    import numpy as np

    rng = np.random.default_rng(2)
    x = rng.normal(0, 100, (4000, 16)).astype(np.int64)
    block = T.Block(np.arange(4000), x)
    q, depth = x[[17]] * 3, []
    bounds = block.bounds
    block.bounds = lambda *a: depth.append(a[1]) or bounds(*a)
    left = block.read(np.array([17]), q, 10, np.array([-np.inf]))[0]
    assert len(left) <= 1000 and depth[-1] < 4000
    scores = x @ q[0]
    scores[17] = -(10**9)
    assert set(np.argsort(-scores, kind="stable")[:10]) <= set(left)
    low, high = bounds(q.astype(float), 1500)
    assert (low[:, 0] <= x @ q[0]).all() and (high[:, 0] >= x @ q[0]).all()
    few = block.read(np.array([17]), q, 10, np.array([np.sort(scores)[-10]], float))[0]
    assert set(np.argsort(-scores, kind="stable")[:10]) <= set(few)


def test_integer_vectors(spark):
    frame = spark.createDataFrame([([0.5, -0.0001],), ([float("nan"), 1.0],), ([None, 1.0],), ([float("inf")],), (None,), ([],)], "x array<double>")
    got = [r[0] for r in frame.select(T.integer_vector(frame["x"])).collect()]
    assert got == [[512, -1], None, None, None, None, []]
