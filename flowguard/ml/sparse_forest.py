"""Isolation forest over term weights and their rolling windows, with the whole vocabulary as features.

A document has one weight per term and, per window, the mean and deviation of that weight over the documents of the last
seconds. Almost all of it is zero, and nothing here makes a row for a zero:

* A tree needs the cells of its sample only. Within a node a feature ranges over its cells there and, where rows lack a cell, over
  zero; the split feature is drawn among those that vary, the cut uniformly within their range. Scaling features would change
  neither, so there is no scaler.
* Features keep their names: a node says (term, kind). No dense numbering of the vocabulary is needed.
* Scoring looks values up where a walk asks for them. Terms that no node names are left out before the windows; sums over the
  last seconds are differences of running sums in time buckets with a halo, for all documents and trees of a level at once.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.ml.iforest import IN_TASK_SAMPLE, path_correction, sampled_rows
from flowguard.ml.sampling import Sampler, placed
from flowguard.session import checkpointed

WINDOWS = (10, 60, 600)
DOCS_PER_TASK = 20_000
BROADCAST_ROWS = 1_000_000  # sampled rows and forest terms are broadcast up to so many, joined beyond
FLAT = 1e-9  # a variance below this share of the mean square is rounding
NODES = "treeID int, id int, term string, kind int, featureValue double, leftChild int, rightChild int, numInstance long"


def kinds(windows=WINDOWS) -> list[str]:
    """Feature kinds by number: the weight itself, then mean and deviation of each window."""
    return ["weight"] + [f"{name}_{w}" for w in windows for name in ("mean", "std")]


def small(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint for a side of at most ``rows`` rows, if that is a size to broadcast."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def sparse_tree(count: int, copies: np.ndarray, feature: np.ndarray, row: np.ndarray, value: np.ndarray, depth: int, seed: list[int]) -> list[tuple]:
    """One tree over ``count`` rows as (id, feature, cut, left, right, rows) in pre-order.

    Cells (feature, row, value) are sorted by feature; what has no cell is zero. Feature and cut of a node follow from the seed
    and the node's number in the full binary tree alone.
    """
    limit = min(depth, math.ceil(math.log2(max(2, int(copies.sum())))))
    nodes: list[list] = []
    stack = [(np.arange(count), feature, row, value, 0, 1, -1, 3)]
    while stack:
        rows, f, r, v, level, number, parent, side = stack.pop()
        here = len(nodes)
        if parent >= 0:
            nodes[parent][side] = here
        size, split = int(copies[rows].sum()), None
        if level < limit and size > 1 and len(f):
            first = np.flatnonzero(np.concatenate([[True], f[1:] != f[:-1]]))
            low, high = np.minimum.reduceat(v, first), np.maximum.reduceat(v, first)
            partly = np.diff(np.append(first, len(f))) < len(rows)
            low, high = np.where(partly, np.minimum(low, 0), low), np.where(partly, np.maximum(high, 0), high)
            varies = np.flatnonzero(low < high)
            if len(varies):
                rng = np.random.default_rng([*seed, number])
                pick = varies[rng.integers(len(varies))]
                split = int(f[first[pick]]), low[pick] + rng.random() * (high[pick] - low[pick])
                if not low[pick] < split[1]:
                    split = split[0], high[pick]  # the range is too narrow for a number between
        if split is None:
            nodes.append([here, -1, -1.0, -1, -1, size])
            continue
        nodes.append([here, split[0], split[1], -1, -1, 0])
        x = np.zeros(count)
        mine = f == split[0]
        x[r[mine]] = v[mine]
        left = np.zeros(count, bool)
        left[rows] = x[rows] < split[1]
        for goes, child, slot in ((False, 2 * number + 1, 4), (True, 2 * number, 3)):
            cells = left[r] == goes
            stack.append((rows[left[rows] == goes], f[cells], r[cells], v[cells], level + 1, child, here, slot))
    return [tuple(n) for n in nodes]


def moments(s, q, n):
    """(mean, deviation) of n numbers from their sum and sum of squares, deviation 0 for a single one."""
    n = np.maximum(n, 1)
    rest = q - s * s / n
    return s / n, np.where((n > 1) & (rest > FLAT * q), np.sqrt(np.maximum(rest, 0) / np.maximum(n - 1, 1)), 0.0)


def windowed_at(cells: DataFrame, at: DataFrame, at_rows: int, keys: list[str], sums: list[str], windows) -> DataFrame:
    """(keys, sec, <sum>_<w>): sums over the last w seconds of (keys, sec, sums) rows at the given seconds.

    Rows meet the seconds of their own and the next time bucket; the seconds are few (those of a sample).
    """
    wide = max(windows)
    rows = cells.withColumnRenamed("sec", "_c").withColumn("_b", F.explode(F.array(*[F.floor(F.col("_c") / wide) + i for i in (0, 1)])))
    asked = small(at.select("sec", F.floor(F.col("sec") / wide).alias("_b")), at_rows)
    met = rows.join(asked, "_b").filter((F.col("_c") <= F.col("sec")) & (F.col("_c") > F.col("sec") - wide))
    return met.groupBy(*keys, "sec").agg(*[F.sum(F.when(F.col("_c") > F.col("sec") - w, F.col(c))).alias(f"{c}_{w}") for c in sums for w in windows])


def term_cells(weights: DataFrame, docs: DataFrame) -> DataFrame:
    """(term, sec, s, q): sum and sum of squares of a term's weights over the documents of a second."""
    return weights.join(docs.select("id", "sec"), "id").groupBy("term", "sec").agg(
        F.sum("weight").alias("s"), F.sum(F.col("weight") * F.col("weight")).alias("q"))


def tree_cells(part: pa.Table, windows) -> tuple:
    """(copies, names, feature, row, value) of one tree's sample: copies per row, and cells sorted by feature and row without
    zeros. ``names`` gives the (term, kind) of a feature's number.

    Terms stay Arrow text and become numbers in their order; cells are three plain arrays.
    """
    marks = part.filter(pc.is_null(part.column("term")))
    order = np.argsort(marks.column("row").to_numpy())
    known, copies = marks.column("row").to_numpy()[order], marks.column("weight").to_numpy()[order].astype(np.int64)
    cells = part.filter(pc.is_valid(part.column("term")))
    coded = cells.column("term").combine_chunks().dictionary_encode()
    terms, by_name = coded.dictionary, pc.array_sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(terms), np.int64)
    place[by_name] = np.arange(len(terms))
    width = 1 + 2 * len(windows)
    # One number per cell: its term, kind and row.
    spot = place[coded.indices.to_numpy()] * (width * len(known)) + np.searchsorted(known, cells.column("row").to_numpy())
    weight = cells.column("weight").to_numpy()
    own = ~np.isnan(weight)
    keys, values = [spot[own]], [weight[own]]
    spot = spot[~own]
    for i, w in enumerate(windows):
        s, q, n = (np.nan_to_num(cells.column(f"{c}_{w}").to_numpy()[~own]) for c in ("s", "q", "n"))
        for j, value in enumerate(moments(s, q, n)):
            keys.append((spot + (1 + 2 * i + j) * len(known))[value != 0])
            values.append(value[value != 0])
    keys[0], values[0] = keys[0][values[0] != 0], values[0][values[0] != 0]
    key, value = np.concatenate(keys), np.concatenate(values)
    del keys, values
    order = np.argsort(key)
    key, value = key[order], value[order]
    row, key = (key % max(len(known), 1)).astype(np.int32), key // max(len(known), 1)
    numbers = key[np.flatnonzero(np.diff(key, prepend=-1))]
    feature = np.cumsum(np.diff(key, prepend=-1) != 0, dtype=np.int32) - np.int32(1)

    def names(number: int) -> tuple[str, int]:
        return terms[int(by_name[numbers[number] // width])].as_py(), int(numbers[number] % width)

    return copies, names, feature, row, value


@dataclass
class SparseForest:
    """Fitted forest: nodes name their feature by term and kind; bounded by trees and height."""

    nodes: pd.DataFrame
    sample_size: int
    windows: tuple = WINDOWS

    @staticmethod
    def fit(
        weights: DataFrame, docs: DataFrame, numTrees: int = 100, maxSamples: float = 256, maxDepth: int = 10, maxFeatures: float = 1.0,
        bootstrap: bool = False, seed: int = 1, windows=WINDOWS,
    ) -> "SparseForest":
        """Forest over (id, term, weight) cells of the documents (id, sec); documents without cells count as all zero.

        ``maxFeatures`` is the share of the vocabulary a tree draws from, by a hash: a tree's task holds its sample times the
        terms that occur within the longest window, times this share.
        """
        rows, starts = placed(docs.select(F.struct("id", "sec").alias("x")))
        total = int(starts[-1])
        size = int(maxSamples) if maxSamples > 1 else int(maxSamples * total)
        if not 1 <= size <= min(total, IN_TASK_SAMPLE):
            raise ValueError(f"a sample of {size} rows: the data has {total}, a tree takes 1 to {IN_TASK_SAMPLE}")
        sample = sampled_rows(rows, Sampler(starts, size, bootstrap, seed), numTrees)
        sample = checkpointed(sample.select("tree", "row", "copies", "x.id", "x.sec"))
        drawn = numTrees * size
        at = sample.select("sec").distinct()
        seconds = docs.groupBy("sec").agg(F.count("*").alias("n"))
        counts = windowed_at(seconds, at, drawn, [], ["n"], windows)
        sums = windowed_at(checkpointed(term_cells(weights, docs)), at, drawn, ["term"], ["s", "q"], windows)
        own = weights.join(small(sample.select("id", "tree", "row"), drawn), "id").select("tree", "row", "term", "weight", F.lit(None).cast("long").alias("sec"))
        seen = sums.join(small(counts, drawn), "sec").join(small(sample.select("sec", "tree", "row"), drawn), "sec")
        names = [f"{c}_{w}" for c in ("n", "s", "q") for w in windows]
        cells = own.select("tree", "row", "term", "weight", *[F.lit(None).cast("double").alias(c) for c in names]).unionByName(
            seen.select("tree", "row", "term", F.lit(None).cast("double").alias("weight"), *[F.col(c).cast("double").alias(c) for c in names]))
        if maxFeatures < 1:
            cells = cells.filter(F.pmod(F.xxhash64(F.lit(seed), "tree", "term"), F.lit(1 << 20)) < maxFeatures * (1 << 20))
        empty = sample.select("tree", "row", F.lit(None).cast("string").alias("term"), F.col("copies").cast("double").alias("weight"), *[F.lit(None).cast("double").alias(c) for c in names])

        def build(part: pa.Table) -> pa.Table:
            tree = part.column("tree")[0].as_py()
            copies, names, feature, at, value = tree_cells(part, windows)
            del part
            made = sparse_tree(len(copies), copies, feature, at, value, maxDepth, [seed, tree])
            out = pd.DataFrame(made, columns=["id", "feature", "featureValue", "leftChild", "rightChild", "numInstance"])
            split = out["feature"].to_numpy()
            term, kind = zip(*[names(f) if f >= 0 else (None, -1) for f in split.tolist()])
            table = {"treeID": np.full(len(out), tree), "id": out["id"], "term": term, "kind": np.array(kind, np.int32)}
            table |= {c: out[c] for c in ("featureValue", "leftChild", "rightChild", "numInstance")}
            types = [pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.int64()]
            return pa.table([pa.array(v, t, from_pandas=True) for v, t in zip(table.values(), types)], names=list(table))

        nodes = cells.unionByName(empty).groupBy("tree").applyInArrow(build, NODES).toPandas()
        return SparseForest(nodes.sort_values(["treeID", "id"], ignore_index=True), size, tuple(windows))

    def terms(self) -> list[str]:
        """Terms that some node asks for; at most one per node."""
        return sorted(self.nodes.loc[self.nodes["kind"] >= 0, "term"].unique())

    def score(self, weights: DataFrame, docs: DataFrame, bucket: int = 3600) -> DataFrame:
        """(id, score) of every document, between 0 and 1, high for unusual ones; score 0.5 if the sample had one row.

        Documents of a busy time bucket are dealt to several tasks, each with the bucket's sums of the forest's terms.
        """
        spark, windows = docs.sparkSession, self.windows
        bucket = max(bucket, *windows)
        names = self.terms()
        codes = spark.createDataFrame([(t, i) for i, t in enumerate(names)], "term string, code int")
        own = checkpointed(weights.join(small(codes, len(names)), "term").select("id", "code", "weight"))
        times = checkpointed(docs.select("id", "sec"))
        cells = own.join(times, "id").groupBy("code", "sec").agg(F.sum("weight").alias("s"), F.sum(F.col("weight") * F.col("weight")).alias("q"))
        counts = times.groupBy("sec").agg(F.count("*").cast("double").alias("s")).select(F.lit(-1).alias("code"), "sec", "s", F.lit(0.0).alias("q"))
        slot = F.floor(F.col("sec") / bucket)
        ways = times.groupBy(slot.alias("slot")).agg(F.ceil(F.count("*") / DOCS_PER_TASK).cast("int").alias("ways"))
        copies = cells.unionByName(counts).withColumn("slot", F.explode(F.sequence(slot, F.floor((F.col("sec") + max(windows) - 1) / bucket))))
        copies = copies.join(ways, "slot").withColumn("way", F.explode(F.sequence(F.lit(0), F.col("ways") - 1)))
        copies = copies.select("slot", "way", "code", F.col("sec").alias("at"), "s", "q")  # other columns than those of ``asked``
        held = own.groupBy("id").agg(F.collect_list("code").alias("codes"), F.collect_list("weight").alias("weights"))
        asked = times.join(held, "id", "left").withColumn("slot", slot).join(ways, "slot").withColumn("way", F.pmod(F.xxhash64("id"), F.col("ways")).cast("int"))
        shared = spark.sparkContext.broadcast(_Walk(self, names))
        kind = dict(docs.dtypes)["id"]

        def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"id": left["id"], "score": shared.value.scores(left, right) if len(left) else np.zeros(0)})

        key = ["slot", "way"]
        return asked.drop("ways").groupBy(*key).cogroup(copies.groupBy(*key)).applyInPandas(run, f"id {kind}, score double")

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        spark.createDataFrame(self.nodes, NODES).write.mode("overwrite").parquet(f"{path}/nodes")
        about = json.dumps({"sample_size": self.sample_size, "windows": list(self.windows)})
        spark.createDataFrame([(about,)], "about string").write.mode("overwrite").parquet(f"{path}/about")

    @staticmethod
    def load(path: str) -> "SparseForest":
        spark = SparkSession.getActiveSession()
        about = json.loads(spark.read.parquet(f"{path}/about").first()["about"])
        nodes = spark.read.parquet(f"{path}/nodes").orderBy("treeID", "id").toPandas()
        return SparseForest(nodes, about["sample_size"], tuple(about["windows"]))


class _Walk:
    """All trees as flat arrays, walked by the documents of one time bucket together."""

    def __init__(self, forest: SparseForest, names: list[str]):
        nodes = forest.nodes
        tree = nodes["treeID"].to_numpy()
        self.windows = forest.windows
        self.roots = np.flatnonzero(np.concatenate([[True], tree[1:] != tree[:-1]]))
        base = self.roots[np.searchsorted(tree[self.roots], tree)]
        leaf = nodes["kind"].to_numpy() < 0
        here = np.arange(len(nodes))
        self.left = np.where(leaf, here, base + nodes["leftChild"])
        self.right = np.where(leaf, here, base + nodes["rightChild"])
        number = {t: i for i, t in enumerate(names)}
        self.code = np.array([number.get(t, -1) for t in nodes["term"]], np.int64)
        self.kind, self.cut, self.leaf = nodes["kind"].to_numpy(np.int64), nodes["featureValue"].to_numpy(float), leaf
        depth = np.zeros(len(nodes), int)
        for i in np.flatnonzero(~leaf):
            depth[[self.left[i], self.right[i]]] = depth[i] + 1
        self.steps = int(depth.max(initial=0))
        self.path = np.where(leaf, depth + path_correction(nodes["numInstance"]), 0.0)
        self.norm = float(path_correction(forest.sample_size))
        self.terms = len(names)

    def scores(self, docs: pd.DataFrame, cells: pd.DataFrame, block: int = 4096) -> np.ndarray:
        cells = cells.rename(columns={"at": "sec"}).sort_values(["code", "sec"])
        first = int(min(cells["sec"].min(), docs["sec"].min()))
        # One number per (term, second) finds running sums by bisection; code -1 holds the documents per second.
        span = int(max(cells["sec"].max(), docs["sec"].max())) - first + max(self.windows) + 2
        key = (cells["code"].to_numpy(np.int64) + 1) * span + (cells["sec"].to_numpy(np.int64) - first + max(self.windows) + 1)
        run = {c: np.concatenate([[0], np.cumsum(cells[c].to_numpy().astype(np.longdouble))]) for c in ("s", "q")}
        sec = docs["sec"].to_numpy(np.int64) - first + max(self.windows) + 1
        sizes = np.array([0 if c is None else len(c) for c in docs["codes"]])
        held = np.repeat(np.arange(len(docs)), sizes) * self.terms + np.concatenate([np.zeros(0, np.int64), *[c for c in docs["codes"] if c is not None]]).astype(np.int64)
        weight = np.concatenate([np.zeros(0), *[w for w in docs["weights"] if w is not None]])
        order = np.argsort(held)
        held, weight = held[order], weight[order]

        def lately(which: str, code: np.ndarray, at: np.ndarray, w: int) -> np.ndarray:
            start = (code + 1) * span
            upto, after = np.searchsorted(key, start + at, side="right"), np.searchsorted(key, start + at - w, side="right")
            return (run[which][upto] - run[which][after]).astype(float)

        def values(doc: np.ndarray, code: np.ndarray, kind: np.ndarray) -> np.ndarray:
            out = np.zeros(len(doc))
            own = np.flatnonzero(kind == 0)
            if len(own) and len(held):
                wanted = doc[own] * self.terms + code[own]
                at = np.minimum(np.searchsorted(held, wanted), len(held) - 1)
                out[own] = np.where(held[at] == wanted, weight[at], 0.0)
            for i, w in enumerate(self.windows):
                some = np.flatnonzero((kind == 1 + 2 * i) | (kind == 2 + 2 * i))
                if len(some):
                    at, c = sec[doc[some]], code[some]
                    mean, deviation = moments(lately("s", c, at, w), lately("q", c, at, w), lately("s", np.full(len(some), -1), at, w))
                    out[some] = np.where(kind[some] == 1 + 2 * i, mean, deviation)
            return out

        out = np.full(len(docs), 0.5)
        for a in range(0, len(docs), block):
            node = np.tile(self.roots, (min(block, len(docs) - a), 1))
            for _ in range(self.steps):
                doc, tree = np.nonzero(~self.leaf[node])
                here = node[doc, tree]
                low = values(doc + a, self.code[here], self.kind[here]) < self.cut[here]
                node[doc, tree] = np.where(low, self.left[here], self.right[here])
            if self.norm > 0:
                out[a : a + block] = np.exp2(-self.path[node].mean(axis=1) / self.norm)
        return out
