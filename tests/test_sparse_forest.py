"""The sparse text forest against dense arrays over the whole vocabulary."""

import numpy as np
import pandas as pd
import pytest

from flowguard.ml import sparse_forest as S
from flowguard.ml.iforest import path_correction
from flowguard.plans import syslog

WINDOWS = (5, 40)


def small_log(seed=0, docs=120):
    rng = np.random.default_rng(seed)
    sec = np.sort(rng.integers(0, 150, docs)) + 1000
    sec[40:80] = sec[40]  # many documents of one second
    cells = [(i, f"t{t}", float(np.round(rng.random(), 3) + 0.05)) for i in range(docs - 1) for t in rng.choice(12, rng.integers(0, 5), replace=False)]
    return cells, [(i, int(s)) for i, s in enumerate(sec)]


def dense(cells, docs, windows=WINDOWS):
    """(feature names, documents x features) with every zero in place."""
    terms = sorted({t for _, t, _ in cells})
    w = np.zeros((len(docs), len(terms)))
    for i, t, v in cells:
        w[i, terms.index(t)] = v
    sec = np.array([s for _, s in docs])
    parts = [w]
    for width in windows:
        near = (sec[None] <= sec[:, None]) & (sec[None] > sec[:, None] - width)
        mean = np.stack([w[m].mean(0) for m in near])
        std = np.stack([w[m].std(0, ddof=1) if m.sum() > 1 else np.zeros(len(terms)) for m in near])
        parts += [mean, np.where(std < 1e-7, 0, std)]
    return [(t, k) for k in range(len(parts)) for t in terms], np.concatenate(parts, axis=1)


def walked(nodes, names, x, size):
    column = {n: i for i, n in enumerate(names)}
    depths = []
    for _, tree in nodes.groupby("treeID"):
        by = tree.set_index("id")
        out = []
        for row in x:
            at, depth = 0, 0
            while by.loc[at, "kind"] >= 0:
                n = by.loc[at]
                value = row[column[n["term"], n["kind"]]] if (n["term"], n["kind"]) in column else 0.0
                at, depth = int(n["leftChild"] if value < n["featureValue"] else n["rightChild"]), depth + 1
            out.append(depth + float(path_correction(by.loc[at, "numInstance"])))
        depths.append(out)
    return 2 ** (-np.mean(depths, axis=0) / float(path_correction(size)))


def frames(spark, cells, docs):
    return spark.createDataFrame(cells, "id long, term string, weight double"), spark.createDataFrame(docs, "id long, sec long")


def test_scores_equal_a_dense_walk(spark, monkeypatch):
    cells, docs = small_log()
    weights, times = frames(spark, cells, docs)
    forest = S.SparseForest.fit(weights, times, numTrees=12, maxSamples=60, seed=4, windows=WINDOWS)
    names, x = dense(cells, docs)
    monkeypatch.setattr(S, "DOCS_PER_TASK", 9)  # the busy second goes to several tasks
    got = {r["id"]: r["score"] for r in forest.score(weights, times, bucket=50).collect()}
    assert list(got) != [] and np.allclose([got[i] for i, _ in docs], walked(forest.nodes, names, x, 60), atol=1e-12)
    later, sooner = small_log(5)
    names, x = dense(later, sooner)
    got = {r["id"]: r["score"] for r in forest.score(*frames(spark, later, sooner), bucket=40).collect()}
    assert np.allclose([got[i] for i, _ in sooner], walked(forest.nodes, names, x, 60), atol=1e-12)


def test_trees_split_what_their_sample_has(spark):
    cells, docs = small_log(1)
    forest = S.SparseForest.fit(*frames(spark, cells, docs), numTrees=6, maxSamples=120, seed=2, windows=WINDOWS)
    names, x = dense(cells, docs)
    column = {n: i for i, n in enumerate(names)}
    for _, tree in forest.nodes.groupby("treeID"):
        by, todo = tree.set_index("id"), [(0, np.arange(len(docs)))]
        while todo:
            at, rows = todo.pop()
            n = by.loc[at]
            if n["kind"] < 0:
                assert n["numInstance"] == len(rows)
                continue
            value = x[rows, column[n["term"], n["kind"]]]
            assert value.min() - 1e-9 <= n["featureValue"] <= value.max() + 1e-9
            todo += [(int(n["leftChild"]), rows[value < n["featureValue"]]), (int(n["rightChild"]), rows[value >= n["featureValue"]])]
    assert len(set(forest.nodes["kind"])) > 4  # weights and windows alike


def test_implied_zeros_and_constants():
    copies = np.ones(4, np.int64)
    never = S.sparse_tree(4, copies, np.zeros(4, int), np.arange(4), np.full(4, 2.5), 5, [1, 0])
    assert never == [(0, -1, -1.0, -1, -1, 4)]  # equal in all rows
    once = S.sparse_tree(4, copies, np.array([7]), np.array([2]), np.array([2.5]), 5, [1, 0])
    assert once[0][1] == 7 and 0 < once[0][2] <= 2.5 and sorted(n[5] for n in once if n[1] < 0) == [1, 3]
    below = S.sparse_tree(3, copies[:3], np.array([3]), np.array([0]), np.array([-1.0]), 5, [1, 0])
    assert -1 < below[0][2] <= 0
    assert S.sparse_tree(3, copies[:3], np.zeros(0, int), np.zeros(0, int), np.zeros(0), 5, [1]) == [(0, -1, -1.0, -1, -1, 3)]


def test_sizes_subsets_and_saving(spark, tmp_path):
    cells, docs = small_log(2)
    weights, times = frames(spark, cells, docs)
    with pytest.raises(ValueError):
        S.SparseForest.fit(weights, times, maxSamples=500)
    forest = S.SparseForest.fit(weights, times, numTrees=10, maxSamples=50, maxFeatures=0.3, bootstrap=True, windows=WINDOWS)
    per_tree = forest.nodes[forest.nodes["kind"] >= 0].groupby("treeID")["term"].agg(set)
    assert per_tree.map(len).max() <= 8 and len(set.union(*per_tree)) > per_tree.map(len).max()
    forest.save(str(tmp_path / "forest"))
    again = S.SparseForest.load(str(tmp_path / "forest"))
    pd.testing.assert_frame_equal(forest.nodes, again.nodes, check_dtype=False)
    first, second = ({r["id"]: r["score"] for r in f.score(weights, times).collect()} for f in (forest, again))
    assert first == second and len(first) == len(docs)


def test_saved_syslog_forest_scores_alike_and_names_rejects(spark, tmp_path):
    lines = [(k, f"Jan  5 08:{k // 60:02}:{k % 60:02} h app: user u{k % 7} logged in") for k in range(100)] + [(200, "no syslog line"), (201, None)]
    frame = spark.createDataFrame(lines, "id long, line string")
    model = syslog.SyslogForest.fit(frame, numTrees=10, maxSamples=64)
    model.save(str(tmp_path / "model"))
    a, b = ({r["id"]: (r["anomalyScore"], r["is_anomalous"]) for r in m.score(frame).collect()} for m in (model, syslog.SyslogForest.load(str(tmp_path / "model"))))
    assert a == b and len(a) == 100 and all(-1 <= s <= 0 and f == (s < syslog.CUTOFF) for s, f in a.values())
    assert {r["id"] for r in syslog.rejects(frame).collect()} == {200, 201}


def test_cells_of_a_tree_take_little_more_than_their_numbers():
    import tracemalloc

    import pyarrow as pa

    rng, rows, n = np.random.default_rng(1), 64, 40_000
    term = np.array([f"term{i:05d}" for i in rng.permutation(n)])
    names = [f"{c}_{w}" for c in ("n", "s", "q") for w in (10, 60, 600)]
    sums = {c: np.append(rng.random(n) + (c[0] == "n") * 5, np.full(rows, np.nan)) for c in names}
    part = pa.table({
        "tree": np.zeros(n + rows, int), "row": np.append(rng.integers(0, rows, n), np.arange(rows)) * 3, "term": pa.array([*term, *[None] * rows]),
        "weight": pa.array([None] * n + [2.0] * rows), **{c: pa.array(v, from_pandas=True) for c, v in sums.items()}})
    tracemalloc.start()
    copies, name, feature, row, value = S.tree_cells(part, (10, 60, 600))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert copies.tolist() == [2] * rows and len(value) <= 6 * n and (value != 0).all()
    assert (np.diff(feature) >= 0).all() and [name(f) for f in feature[[0, -1]]][0][0] < name(feature[-1])[0]
    at = int(np.flatnonzero(part.column("term").to_numpy()[:n] == name(0)[0])[0])
    assert name(0)[1] == 1 and value[0] == sums["s_10"][at] / sums["n_10"][at] and row[0] * 3 == part.column("row")[at].as_py()
    assert peak < 6 * n * 60, peak / (6 * n)
