import numpy as np
import pytest

from flowguard.llm import ann as A

SCHEMA = "vec_id long, embedding array<double>, id string, x int, dim string, shard string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "i", 1, "d", "s") for i, v in rows], SCHEMA)


def usable(v):
    return v is not None and all(c is not None and np.isfinite(c) for c in v) and any(v)


def brute(queries, rows, k):
    held = sorted({(i, tuple(v)) for i, v in rows if i is not None and usable(v)})
    out = {}
    for qi, q in {(i, tuple(v)) for i, v in queries if i is not None and usable(v)}:
        scored = sorted((-float((np.array(v) * np.array(q)).sum()), i) for i, v in held if i != qi and len(v) == len(q))
        out[qi] = [(i, -s) for s, i in scored[:k]]
    return out


def answer(spark, queries, rows, k):
    out = {}
    for r in sorted(A.search(frame(spark, queries), frame(spark, rows), "vec_id", "embedding", k).collect(), key=lambda r: r["rank"]):
        assert r["rank"] == len(out.setdefault(r["query_id"], [])) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def recall(got, want):
    return sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items()) / max(1, sum(map(len, want.values())))


def test_recall_and_scores_over_shards(spark, monkeypatch):
    monkeypatch.setattr(A.index, "__defaults__", (400,))
    monkeypatch.setattr(A, "QUERY_ROWS", 30)
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(0, 1, 24).tolist()) for i in range(1500)]
    rows += [(5000 + i, (rng.normal(0, 1, 24) * 3).tolist()) for i in range(100)]  # long ones win many inner products
    queries = rows[::20]
    got, want = answer(spark, queries, rows, 10), brute(queries, rows, 10)
    assert recall(got, want) >= 0.95
    held = dict(rows)
    for q, found in got.items():
        assert len(found) == 10 and found == sorted(found, key=lambda f: (-f[1], f[0])) and q not in dict(found)
        for i, s in found:
            assert s == pytest.approx(float(np.dot(held[q], held[i])), abs=1e-12)


def test_equal_vectors_ties_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 1, 8).tolist()) for i in range(300)]
    rows += [(1000 + i, [4.0, -0.0] + [2.0] * 6) for i in range(700)] + [(990, [4.0, 0.0] + [2.0] * 6)]  # a third and more is one vector
    rows += [rows[3], rows[3], (2000, [1.0, 2.0]), (2020, [3.0, 4.0]), (2040, [])]
    odd = [(3000, None), (None, [1.0] * 8), (3020, [0.0] * 8), (3040, [float("nan")] * 8), (3060, [None] + [1.0] * 7), (3080, [float("inf")] * 8)]
    queries = [r for r in rows + odd if r[0] is None or r[0] % 20 == 0] + [rows[20]]
    got, want = answer(spark, queries, rows + odd, 12), brute(queries, rows + odd, 12)
    assert set(got) == {q for q, w in want.items() if w} and recall(got, want) >= 0.95
    assert got[1000] == [(i, 40.0) for i in (990, *range(1001, 1012))] == want[1000]
    assert [i for i, _ in got[2000]] == [2020]


def test_few_rows_and_empty_tables(spark):
    rows = [(0, [1.0, 2.0]), (20, [2.0, 1.0])]
    assert answer(spark, rows, rows, 5) == {0: [(20, 4.0)], 20: [(0, 4.0)]}
    assert answer(spark, rows[:1], rows[:1], 5) == {} == answer(spark, [], rows, 5) == answer(spark, rows, [], 5)


def test_sphere_keeps_the_order_of_inner_products():
    rng = np.random.default_rng(2)
    x, q = rng.normal(0, 1, (500, 6)) * rng.exponential(1, (500, 1)), rng.normal(0, 1, (20, 6))
    s = A.on_sphere(x)
    assert np.allclose((s**2).sum(1), 1, atol=1e-6)
    assert (np.argsort(A.as_queries(q) @ s.T)[:, -5:] == np.argsort(q @ x.T)[:, -5:]).mean() > 0.98


def test_graph_links_and_layers():
    rng = np.random.default_rng(3)
    points = A.on_sphere(rng.normal(0, 1, (3000, 10)))
    graph = A.build(points)
    sizes = [len(links) for links in graph.layers]
    assert sizes == sorted(sizes) and sizes[-1] == 3000 and len(sizes) > 1
    for depth, links in enumerate(graph.layers):
        assert links.shape[1] == A.LINKS * (2 if depth == len(sizes) - 1 else 1) and links.max() < len(links)
        for i, row in enumerate(links):
            own = row[row >= 0]
            assert len(set(own.tolist())) == len(own) and i not in own
    found = graph.search(points[::30], 40)
    assert (found[:, 0] == np.arange(0, 3000, 30)).mean() > 0.97  # a point finds itself
    walked, sims = graph.walk(points[:5], np.zeros((5, 1), np.int64), graph.layers[-1], 50)
    assert all(len(set(r.tolist())) == 50 for r in walked) and (np.diff(sims, axis=1) <= 0).all()


def test_query_over_its_table(spark):
    import duckdb

    folder = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{folder}/embeddings.parquet'").fetchall()
    want = brute([r for r in rows if r[0] % 20 == 0], rows, 20)
    got = {}
    for r in A.op12_navigable_graph(spark, folder).collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert recall(got, want) >= 0.98
