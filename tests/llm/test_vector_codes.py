import math
import random

import numpy as np
import pytest

from flowguard.llm import vector_codes as V


def brute_codes(vectors, ids, parts, entries, rounds):
    """Plain loops over Python integers: (codes, errors, books)."""
    width = -(-max(len(v) for v in vectors) // parts)
    cut = [[(v + [0] * (parts * width))[p * width : (p + 1) * width] for p in range(parts)] for v in vectors]
    first = {}
    for i, v in zip(ids, vectors):
        if i is not None:
            first[i] = min(first.get(i, v), v)
    seeds = [(first[i] + [0] * (parts * width))[: parts * width] for i in sorted(first)[:entries]]
    books = [[s[p * width : (p + 1) * width] for s in seeds] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(near(c[p], books[p])[1], []).append(c[p])
            for e, rows in groups.items():
                books[p][e] = [sum(col) // len(rows) for col in zip(*rows)]
    found = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    return ["".join(f"{i:02x}" for _, i in f) for f in found], [sum(d for d, _ in f) for f in found], books


def test_transform_rows_are_walsh_functions_by_sign_changes():
    for size in (1, 2, 4, 8, 16):
        functions = V.walsh_hadamard(np.eye(size, dtype=np.int64)).T
        assert (np.abs(functions) == 1).all()
        assert [(np.diff(f) != 0).sum() for f in functions] == list(range(size))
        assert (functions @ functions.T == size * np.eye(size)).all()


def test_transform_scales_squared_distances():
    rng = np.random.default_rng(0)
    a, b = (V.padded(rng.integers(-5000, 5000, (50, 7))) for _ in range(2))
    assert (((V.walsh_hadamard(a) - V.walsh_hadamard(b)) ** 2).sum(1) == 8 * ((a - b) ** 2).sum(1)).all()


@pytest.mark.parametrize("width", [0, 1, 3, 8, 13])
def test_nearest_equals_all_distances(width):
    rng = np.random.default_rng(width)
    for spread in (1, 3, 4000):  # a small spread makes many ties
        x, entries = rng.integers(-spread, spread + 1, (500, width)), rng.integers(-spread, spread + 1, (16, width))
        d = ((x[:, None] - entries[None]) ** 2).sum(2)
        index, least = V.nearest(x, entries)
        assert (index == d.argmin(1)).all() and (least == d.min(1)).all()


def test_entries_go_early():
    seen, rng = [], np.random.default_rng(1)
    x, entries = rng.normal(0, 1000, (2000, 8)).cumsum(1).astype(np.int64), rng.normal(0, 1000, (16, 8)).cumsum(1).astype(np.int64)
    nonzero = np.nonzero
    try:
        np.nonzero = lambda a: seen.append(int(a.sum())) or nonzero(a)
        V.nearest(x, entries)
    finally:
        np.nonzero = nonzero
    assert seen[0] < 0.5 * 2000 * 16  # after one of eight numbers more than half of the pairs are out


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, code string, id string, x string, error long, key string")


def test_equal_to_plain_loops(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(20)], rng.choice([0, 0, 0, 1, None])) for i in range(5, 400)]
    rows += [(1000 + i, [0.25] * 20, 7) for i in range(150)]  # one common vector
    rows += [rows[0], rows[1], (6, [9.0] * 20, 2), (None, [1.0] * 20, None), (2000, [0.5] * 3, 1), (2001, [], 1)]  # repeats, null id, short, empty
    dropped = [(1, None, 3), (2, [float("nan")] * 20, 3), (3, [None] * 20, 3), (4, [float("-inf")] + [0.0] * 19, 3)]
    wide = lambda r: (*r, "c", "i", "x", 9, "k")
    got = V.compress(rows_of(spark, [wide(r) for r in rows + dropped]), "vec_id", "embedding", "label", parts=4, entries=16, rounds=3).collect()
    ints = [[math.floor(4096 * float(np.float32(v))) for v in r[1]] for r in rows]
    codes, errors, books = brute_codes(ints, [r[0] for r in rows], 4, 16, 3)
    by_label = {}
    for r, e in zip(rows, errors):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    key = lambda t: tuple((v is None, v) for v in t)
    assert sorted(((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got), key=key) == sorted(
        ((r[0], c, e, by_label[r[2]]) for r, c, e in zip(rows, codes, errors)), key=key)
    assert {r["codebooks_sha256"] for r in got} == {V.digest(np.array(books))}


def test_few_rows_and_empty_tables(spark):
    one = V.compress(rows_of(spark, [(1, [0.5, -0.5], 1, None, None, None, None, None)]), "vec_id", "embedding", "label").collect()
    assert [(r["vec_id"], r["code"], r["error"], r["label_error"]) for r in one] == [(1, "00" * 8, 0, 0)]
    for rows in ([], [(1, None, 1, None, None, None, None, None)], [(None, [0.5], 1, None, None, None, None, None)]):
        none = V.compress(rows_of(spark, rows), "vec_id", "embedding", "label")
        assert none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and none.collect() == []


def test_too_large_components_raise(spark):
    with pytest.raises(OverflowError):
        V.compress(spark.createDataFrame([(1, [1e15], 1)], "vec_id long, embedding array<double>, label int"), "vec_id", "embedding", "label")


def test_encoding_keeps_other_columns(spark):
    books = V.train(spark.createDataFrame([(0, [1, 2]), (1, [5, 6])], "id long, x array<long>"), parts=2, entries=2, rounds=1)
    frame = spark.createDataFrame([("a", [5, 6], "own"), (None, [1, 3], "own")], "name string, x array<long>, code string")
    assert sorted(map(tuple, V.encode(frame, books).collect()), key=str) == [("a", "0101", 0), (None, "0000", 1)]
