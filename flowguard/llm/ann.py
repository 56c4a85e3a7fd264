"""Approximate nearest neighbours by inner product: a hierarchical navigable small-world graph per shard.

Distinct vectors are dealt into shards of bounded size by a hash of the vector; a shard's graph is built in one task and kept as
one row of flat arrays. Queries go to every shard in blocks, each shard answers with its nearest vectors, and one ranking per
query merges the answers, scored again on the original vectors in double precision.

Inner products are searched as distances on a sphere: a vector, divided by the largest length of its shard, gets one more
coordinate that fills its length up to one, queries get a zero there. The order of inner products does not change, and graph
links can be chosen by distances as usual.

A graph is built from the top layer down. Vectors are numbered by falling level, so that every layer holds the first vectors of
the next one, which are linked exactly; the others enter in batches, each searched for from where the layers above lead to.
All queries of a batch walk the graph side by side, so that a step is a handful of array operations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowguard.llm.registry import query, table
from flowguard.llm.tables import Stored

SHARD_ROWS, QUERY_ROWS = 16384, 8192
LINKS = 16  # links per vector and layer, twice as many in the lowest
BUILD_WIDTH, SEARCH_WIDTH = 96, 160  # vectors a walk keeps in view
STEP, BATCH = 4, 512  # vectors opened per step, walks side by side
INDEX = "dim int, shard long, n int, ids array<array<long>>, vectors binary, layers array<int>, links binary"


class Graph:
    """``points`` are unit vectors by falling level; ``layers`` holds (first n points' links, -1 where none) from the top down."""

    def __init__(self, points: np.ndarray, layers: list[np.ndarray]):
        self.points = np.vstack([points, np.zeros((1, points.shape[1]), np.float32)])  # the last one stands for "none"
        self.layers = layers

    def walk(self, q: np.ndarray, start: np.ndarray, links: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(points, similarities), best first, of the ``width`` best points each query sees; -1 and -inf where there are fewer.

        A walk opens the best points in view that are not open yet, until all in view are.
        """
        n, rows = len(links), len(q)
        none = len(self.points) - 1
        place = np.arange(1, STEP * links.shape[1] + start.shape[1] + 1, dtype=np.int16)
        met = np.zeros((rows, none + 1), np.int16)
        met[:, none] = -1
        view = np.full((rows, width), none, np.int64)
        sims = np.full((rows, width), -np.inf, np.float32)
        closed = np.ones((rows, width), bool)
        links = np.vstack([links, np.full((1, links.shape[1]), -1, links.dtype)])
        at, near = np.arange(rows), start
        while len(at):
            near = np.where(near < 0, none, near)
            line = at[:, None]
            fresh = met[line, near] == 0
            r, c = np.nonzero(fresh)
            met[at[r], near[r, c]] = place[c]
            first = met[at[r], near[r, c]] == place[c]  # a point met twice in this step counts once
            r, c = r[first], c[first]
            sim = np.full(near.shape, -np.inf, np.float32)
            sim[r, c] = np.einsum("ij,ij->i", self.points[near[r, c]], q[at[r]])
            all_sims = np.concatenate([sims[at], sim], axis=1)
            best = np.argsort(-all_sims, axis=1, kind="stable")[:, :width]
            sims[at] = np.take_along_axis(all_sims, best, axis=1)
            view[at] = np.take_along_axis(np.concatenate([view[at], near], axis=1), best, axis=1)
            was = np.concatenate([closed[at], np.zeros(near.shape, bool)], axis=1)
            shut = np.take_along_axis(was, best, axis=1) | ~np.isfinite(sims[at])
            order = np.argsort(shut, axis=1, kind="stable")[:, :STEP]  # the best open ones
            opened = ~np.take_along_axis(shut, order, axis=1)
            picked = np.where(opened, np.take_along_axis(view[at], order, axis=1), n)
            np.put_along_axis(shut, order, True, axis=1)
            closed[at] = shut
            goes = opened[:, 0]
            at, near = at[goes], links[np.minimum(picked[goes], n)].reshape(int(goes.sum()), order.shape[1] * links.shape[1])
        return np.where(np.isfinite(sims), view, -1), sims

    def descend(self, q: np.ndarray, upto: int) -> np.ndarray:
        """Points to start from in layer ``upto``: the best ones of the layer above it."""
        start = np.zeros((len(q), 1), np.int64)
        for links in self.layers[:upto]:
            found, _ = self.walk(q, start, links, STEP)
            start = found
        return start

    def search(self, q: np.ndarray, width: int) -> np.ndarray:
        """The ``width`` best points found for each query, best first, -1 where there are fewer."""
        out = [np.zeros((0, width), np.int64)]
        size = max(16, min(BATCH, 64_000_000 // len(self.points)))
        for a in range(0, len(q), size):
            some = q[a : a + size]
            out.append(self.walk(some, self.descend(some, len(self.layers) - 1), self.layers[-1], width)[0])
        return np.concatenate(out)


def spread(points: np.ndarray, cand: np.ndarray, sims: np.ndarray, keep: int) -> np.ndarray:
    """``keep`` of each row's candidates (best first, -1 for none): those nearer to the row's point than to any kept one before
    them, then the nearest others, so that links lead in all directions."""
    rows, width = cand.shape
    own = points[np.where(cand < 0, len(points) - 1, cand)]
    among = own @ own.transpose(0, 2, 1)
    blocked, taken, count = cand < 0, np.zeros((rows, width), bool), np.zeros(rows, np.int64)
    for j in range(width):
        take = ~blocked[:, j] & (count < keep)
        taken[:, j] = take
        count += take
        blocked |= take[:, None] & (among[:, j] >= sims)
    order = np.argsort(np.where(taken, 0, np.where(cand < 0, 2, 1)), axis=1, kind="stable")[:, :keep]
    out = np.take_along_axis(cand, order, axis=1)
    if width < keep:
        out = np.concatenate([out, np.full((rows, keep - width), -1, out.dtype)], axis=1)
    return out


def link_back(points: np.ndarray, links: np.ndarray, fresh: np.ndarray) -> None:
    """Links from the targets of ``fresh`` points back to them; full lists keep a spread choice of old and new."""
    m = links.shape[1]
    target = links[fresh].ravel()
    source = np.repeat(fresh, m)
    source, target = source[target >= 0], target[target >= 0]
    sim = np.einsum("ij,ij->i", points[source], points[target])
    order = np.lexsort((-sim, target))
    source, target, sim = source[order], target[order], sim[order]
    heads, first, count = np.unique(target, return_index=True, return_counts=True)
    rank = np.arange(len(target)) - np.repeat(first, count)
    row = np.repeat(np.arange(len(heads)), count)
    near = rank < m
    came = np.full((len(heads), m), -1, np.int64)
    came[row[near], rank[near]] = source[near]
    for a in range(0, len(heads), BATCH):
        t, new = heads[a : a + BATCH], came[a : a + BATCH]
        new = new[:, : max(1, int((new >= 0).sum(axis=1).max()))]
        old = links[t]
        new = np.where((new[:, :, None] == old[:, None, :]).any(axis=2), -1, new)  # linked in both directions already
        cand = np.concatenate([old, new], axis=1)
        s = np.einsum("ijk,ik->ij", points[np.where(cand < 0, len(points) - 1, cand)], points[t])
        s[cand < 0] = -np.inf
        best = np.argsort(-s, axis=1, kind="stable")
        links[t] = spread(points, np.take_along_axis(cand, best, axis=1), np.take_along_axis(s, best, axis=1), m)


def level_of(n: int, seed: int = 0) -> np.ndarray:
    """Falling levels of ``n`` points: each layer holds about one in ``LINKS`` points of the next."""
    draw = np.random.default_rng(seed).random(n)
    return -np.sort(-np.floor(-np.log(1 - draw) / np.log(LINKS))).astype(np.int64)


def build(points: np.ndarray, width: int = BUILD_WIDTH) -> Graph:
    """The graph over unit vectors; the first points become those of the upper layers."""
    n, level = len(points), level_of(len(points))
    graph = Graph(points, [])
    held = graph.points
    sizes = [int((level >= top).sum()) for top in range(int(level[0]) if n else 0, -1, -1)]
    before = 0
    for depth, size in enumerate(sizes):
        m = LINKS * 2 if depth == len(sizes) - 1 else LINKS
        links = np.full((size, m), -1, np.int64)
        first = min(size, max(before, 2 * m))
        for a in range(0, first, BATCH):  # those of the layer above, or the first ones: all against all
            rows = np.arange(a, min(first, a + BATCH))
            s = held[rows] @ held[:first].T
            s[np.arange(len(rows)), rows] = -np.inf
            cand = np.argsort(-s, axis=1, kind="stable")[:, : min(first - 1, 2 * m)]
            links[rows] = spread(held, cand, np.take_along_axis(s, cand, axis=1), m)
        for a in range(0, first, BATCH):
            link_back(held, links, np.arange(a, min(first, a + BATCH)))
        graph.layers.append(links)
        at = first
        while at < size:
            rows = np.arange(at, min(size, at + min(BATCH, at)))
            q = held[rows]
            found, sims = graph.walk(q, graph.descend(q, depth), links[:at], width)
            own = q @ q.T
            own[np.arange(len(rows)), np.arange(len(rows))] = -np.inf
            nearby = np.argsort(-own, axis=1, kind="stable")[:, :m]  # points that enter together may link too
            cand = np.concatenate([found, rows[nearby]], axis=1)
            s = np.concatenate([sims, np.take_along_axis(own, nearby, axis=1)], axis=1)
            s[cand == rows[:, None]] = -np.inf
            cand = np.where(np.isfinite(s), cand, -1)
            best = np.argsort(-s, axis=1, kind="stable")[:, : width // 2 + m]
            links[rows] = spread(held, np.take_along_axis(cand, best, axis=1), np.take_along_axis(s, best, axis=1), m)
            link_back(held, links, rows)
            at = rows[-1] + 1
        before = size
    return graph


def on_sphere(x: np.ndarray) -> np.ndarray:
    """Unit vectors with one more coordinate, in the order of the vectors' inner products with any query."""
    scaled = x / np.abs(x).max(initial=np.finfo(float).tiny)
    scaled = scaled / np.sqrt((scaled**2).sum(axis=1).max(initial=np.finfo(float).tiny))
    rest = np.sqrt(np.maximum(0, 1 - (scaled**2).sum(axis=1)))
    return np.column_stack([scaled, rest]).astype(np.float32)


def as_queries(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(axis=1, keepdims=True)
    scaled = scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))
    return np.column_stack([scaled, np.zeros(len(x))]).astype(np.float32)


def usable(x: Column) -> Column:
    """The vector in double, zeros without a sign; null if it is null, all zero or has a null or non-finite component."""
    wide = F.transform(x, lambda v: v.cast("double") + F.lit(0.0))
    bad = F.exists(wide, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(~bad & F.exists(wide, lambda v: v != 0), wide)


def clean(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    own = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), usable(F.col(f"`{vector}`")).alias("x"))
    return own.filter("id IS NOT NULL AND x IS NOT NULL").withColumn("dim", F.size("x"))


def fold(ids: list[np.ndarray], x: np.ndarray, k: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal rows of ``x`` once, each with the ``k`` smallest distinct ids among all it had."""
    keys = np.ascontiguousarray(x).view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel()
    _, first, row = np.unique(keys, return_index=True, return_inverse=True)
    order = np.argsort(row.ravel(), kind="stable")
    ends = np.cumsum(np.bincount(row.ravel(), minlength=len(first)))
    named = [np.unique(np.concatenate([ids[j] for j in order[a:b]]))[:k] for a, b in zip([0, *ends[:-1]], ends)]
    return named, x[first]


def index(rows: DataFrame, spare: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row of flat arrays per shard of clean (id, x, dim) rows; a vector keeps its ``spare`` smallest ids.

    Equal vectors fold before they move, so that a vector held by a third of all rows is one row per task.
    """
    shards = max(1, -(-rows.count() // shard_rows))

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("dim").to_numpy()
            for dim in np.unique(sizes):
                at = pa.array(np.flatnonzero(sizes == dim))
                x = batch.column("x").take(at).flatten().to_numpy(zero_copy_only=False).reshape(len(at), dim)
                ids, x = fold(list(batch.column("id").take(at).to_numpy()[:, None]), x, spare)
                columns = [pa.array(np.full(len(x), dim), pa.int32()), pa.array(ids, pa.list_(pa.int64())), pa.array(list(x), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["dim", "ids", "x"])

    def built(part: pa.Table) -> pa.Table:
        dim, shard = part["dim"][0].as_py(), part["shard"][0].as_py()
        x = part["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(part), dim)
        ids, x = fold([np.array(i, np.int64) for i in part["ids"].to_pylist()], x, spare)
        # Levels are drawn by place: a hash of the vector deals the places.
        order = np.argsort(pd.util.hash_array(np.ascontiguousarray(x).view(np.uint64).dot(np.arange(1, 2 * dim, 2, dtype=np.uint64))), kind="stable")
        ids, x = [ids[i] for i in order], x[order]
        graph = build(on_sphere(x))
        small = x.astype(np.float32)
        x = small if (small == x).all() else x
        row = {"dim": [dim], "shard": [shard], "n": [len(x)], "ids": [[i.tolist() for i in ids]], "vectors": [x.tobytes()],
               "layers": [[len(links) for links in graph.layers]], "links": [b"".join(links.astype(np.int32).tobytes() for links in graph.layers)]}
        types = [pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.list_(pa.int64())), pa.binary(), pa.list_(pa.int32()), pa.binary()]
        return pa.table([pa.array(v, t) for v, t in zip(row.values(), types)], names=list(row))

    few = rows.select("id", "dim", "x").mapInArrow(folded, "dim int, ids array<long>, x array<double>")
    dealt = few.withColumn("shard", F.pmod(F.xxhash64("x"), F.lit(shards)))
    return dealt.groupBy("dim", "shard").applyInArrow(built, INDEX)


def opened(row: pd.Series) -> tuple[Graph, np.ndarray, list[np.ndarray]]:
    """(graph, original vectors in double, ids of each) of one index row."""
    n, dim = int(row["n"]), int(row["dim"])
    wide = len(row["vectors"]) == n * dim * 8
    x = np.frombuffer(row["vectors"], np.float64 if wide else np.float32).reshape(n, dim).astype(np.float64)
    flat, layers, at = np.frombuffer(row["links"], np.int32), [], 0
    for depth, size in enumerate(row["layers"]):
        m = LINKS * 2 if depth == len(row["layers"]) - 1 else LINKS
        layers.append(flat[at : at + size * m].reshape(size, m).astype(np.int64))
        at += size * m
    return Graph(on_sphere(x), layers), x, [np.asarray(i, np.int64) for i in row["ids"]]


def answers(query_ids: np.ndarray, q: np.ndarray, shard: pd.Series, k: int, width: int) -> pd.DataFrame:
    """(query_id, vec_id, score) of the k best rows of a shard that each query finds, its own id left out."""
    graph, x, ids = opened(shard)
    out_q, out_v, out_s = [], [], []
    found = graph.search(as_queries(q), max(width, k + 1))
    for i, points in enumerate(found):
        points = points[points >= 0][: 2 * k + 2]
        score = (x[points] * q[i]).sum(axis=1)
        named = [ids[p] for p in points]
        v, s = np.concatenate(named), np.repeat(score, [len(a) for a in named])
        other = v != query_ids[i]
        v, s = v[other], s[other]
        top = np.lexsort((v, -s))[:k]
        out_q.append(np.full(len(top), query_ids[i]))
        out_v.append(v[top])
        out_s.append(s[top])
    return pd.DataFrame({"query_id": np.concatenate(out_q), "vec_id": np.concatenate(out_v), "score": np.concatenate(out_s)})


def nearest(queries: DataFrame, shards: DataFrame, k: int, width: int = SEARCH_WIDTH) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found for clean (id, x, dim) rows in an index; every shard is asked."""
    blocks = max(1, -(-queries.count() // QUERY_ROWS))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks))
    last = shards.agg(F.max("shard")).first()[0] or 0
    asked = queries.select("dim", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long"))).alias("shard"), block.alias("block"), "id", "x")
    held = shards.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        return answers(left["id"].to_numpy(np.int64), np.stack(left["x"].to_list()), right.iloc[0], k, width)

    key = ["dim", "shard", "block"]
    found = asked.groupBy(*key).cogroup(held.groupBy(*key)).applyInPandas(meet, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(queries: DataFrame, candidates: DataFrame, id_col: str, vector: str, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found by inner product, ties to the smaller id.

    Rows whose id or vector is null, whose vector is empty, all zero, or holds a null, NaN or infinite component take no part;
    vectors of another length than the query's are no candidates. A query's own id is none either. A repeated row counts once;
    equal vectors under different ids are candidates of their own, all of them: a vector keeps its k + 1 smallest ids, more
    cannot be among the k nearest. A query without candidates has no rows; empty tables give none. Other columns, whatever
    their names, are not looked at. Scores are sums of products in double precision; what is found is approximate (a walk
    keeps ``SEARCH_WIDTH`` vectors in view), its order and scores are not.
    """
    held = Stored(index(clean(candidates, id_col, vector), k + 1), "graph")
    asked = clean(queries, id_col, vector).dropDuplicates(["id", "x"])
    return nearest(asked, held.df, k)


@query("op12_navigable_graph")
def op12_navigable_graph(spark, folder):
    rows = table(spark, folder, "embeddings")
    return search(rows.filter(F.col("vec_id") % 20 == 0), rows, "vec_id", "embedding", 20)
