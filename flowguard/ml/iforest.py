"""Isolation forest as a Spark ML estimator.

Features are stored once with a place for every row; a tree's sample follows from places alone
(``ml/sampling.py``), whatever its size. Samples that fit a task are fetched in one scan and each
tree is built in its own task. For larger ones all trees grow level by level from aggregated minima
and maxima over the same samples, so no task ever holds one. Both draw a node's split by its seed,
tree and number, so the trees are the same.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.ml.util import MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowguard.functions.scalar import EULER
from flowguard.ml.sampling import Sampler, placed
from flowguard.operators.metrics import rank_quantile

IN_TASK_SAMPLE = 1 << 16

NODE_SCHEMA = T.StructType(
    [
        T.StructField("treeID", T.IntegerType()),
        T.StructField("id", T.IntegerType()),
        T.StructField("featureIndex", T.IntegerType()),
        T.StructField("featureValue", T.DoubleType()),
        T.StructField("leftChild", T.IntegerType()),
        T.StructField("rightChild", T.IntegerType()),
        T.StructField("numInstance", T.LongType()),
    ]
)


def path_correction(n):
    """Expected remaining path below a leaf of n rows."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3)
    long = 2 * (np.log(big - 1) + EULER) - 2 * (big - 1) / big
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


def feature_array(df: DataFrame, column: str) -> Column:
    """Vector or array column as array<double>."""
    if isinstance(df.schema[column].dataType, VectorUDT):
        return vector_to_array(F.col(column))
    return F.col(column).cast("array<double>")


def matrix(column: pa.Array) -> np.ndarray:
    """Arrow list column to a matrix, without Python objects; a null vector is a row of NaN.

    All other vectors must have one length.
    """
    lengths = pc.list_value_length(column)
    known = np.unique(lengths.drop_null().to_numpy())
    if len(known) > 1:
        raise ValueError(f"vectors of different lengths: {known.tolist()}")
    width = int(known[0]) if len(known) else 0
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width) if width else np.empty((0, 0))
    if not column.null_count:
        return flat if width else np.empty((len(column), 0))
    out = np.full((len(column), width), np.nan)
    if width:
        out[column.is_valid().to_numpy(zero_copy_only=False)] = flat
    return out


def per_row(column: pa.Array, compute) -> pa.Array:
    """``compute(matrix)`` for the vectors that are there, null for null ones."""
    valid = column.is_valid()
    some = column.filter(valid)
    out = np.zeros(len(column))
    mask = ~valid.to_numpy(zero_copy_only=False)
    if len(some):
        out[~mask] = compute(matrix(some))
    return pa.array(out, pa.float64(), mask=mask)


def subset_size(max_features: float, d: int) -> int:
    wanted = int(max_features * d) if max_features <= 1 else min(int(max_features), d)
    return max(wanted, 1)


class _ForestParams(Params):
    numTrees = Param(Params._dummy(), "numTrees", "number of trees, > 0", TypeConverters.toInt)
    maxSamples = Param(Params._dummy(), "maxSamples", "rows per tree: share if <= 1, else count", TypeConverters.toFloat)
    maxFeatures = Param(Params._dummy(), "maxFeatures", "features per tree: share if <= 1, else count", TypeConverters.toFloat)
    maxDepth = Param(Params._dummy(), "maxDepth", "height limit, > 0", TypeConverters.toInt)
    contamination = Param(Params._dummy(), "contamination", "share of outliers, in (0, 1]", TypeConverters.toFloat)
    bootstrap = Param(Params._dummy(), "bootstrap", "draw rows with replacement", TypeConverters.toBoolean)
    seed = Param(Params._dummy(), "seed", "random seed", TypeConverters.toInt)
    approxQuantileRelativeError = Param(
        Params._dummy(), "approxQuantileRelativeError", "error of the threshold quantile, 0 is exact", TypeConverters.toFloat
    )
    featuresCol = Param(Params._dummy(), "featuresCol", "vector or array column", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "1.0 for outliers", TypeConverters.toString)
    anomalyScoreCol = Param(Params._dummy(), "anomalyScoreCol", "score column", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label column, unused in training", TypeConverters.toString)
    norm = Param(
        Params._dummy(), "norm", "size that normalises scores: training sample or scored dataset", TypeConverters.toString
    )

    def _set(self, **kwargs):
        for name in ("numTrees", "maxSamples", "maxFeatures", "maxDepth"):
            if kwargs.get(name, 1) <= 0:
                raise ValueError(f"{name} must be > 0")
        if not 0 < kwargs.get("contamination", 0.1) <= 1:
            raise ValueError("contamination must be in (0, 1]")
        if not 0 <= kwargs.get("approxQuantileRelativeError", 0.0) <= 1:
            raise ValueError("approxQuantileRelativeError must be in [0, 1]")
        if kwargs.get("norm", "sample") not in ("sample", "dataset"):
            raise ValueError("norm must be sample or dataset")
        return super()._set(**kwargs)

    def _forest_defaults(self):
        self._setDefault(
            numTrees=100, maxSamples=1.0, maxFeatures=1.0, maxDepth=10, contamination=0.1, bootstrap=False, seed=1,
            approxQuantileRelativeError=0.0, featuresCol="features", predictionCol="prediction",
            anomalyScoreCol="anomalyScore", labelCol="label", norm="sample",
        )

    def __getattr__(self, name):
        """Spark-style accessors: ``getNumTrees()``, ``setNumTrees(50)``."""
        if name[:3] in ("get", "set") and len(name) > 3:
            param = name[3].lower() + name[4:]
            if isinstance(getattr(type(self), param, None), Param):
                if name.startswith("get"):
                    return lambda: self.getOrDefault(param)
                return lambda value: self._set(**{param: value})
        raise AttributeError(name)


class IsolationForest(_ForestParams, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Estimator; ``fit`` returns an :class:`IsolationForestModel`."""

    def __init__(self, **params):
        super().__init__()
        self._forest_defaults()
        self._set(**params)

    def setParams(self, **params):
        return self._set(**params)

    def _fit(self, dataset: DataFrame) -> "IsolationForestModel":
        """Rows whose vector is null are not trained on."""
        data, starts = placed(dataset.select(feature_array(dataset, self.getFeaturesCol()).alias("x")).filter("x IS NOT NULL"))
        total = int(starts[-1])
        wanted = self.getMaxSamples()
        size = int(wanted) if wanted > 1 else int(wanted * total)
        if size > total:
            raise ValueError(f"maxSamples asks for {size} rows, the data has {total}")
        if size < 1:
            raise ValueError("the sample is empty")
        sampler = Sampler(starts, size, self.getBootstrap(), self.getSeed())
        settings = dict(trees=self.getNumTrees(), depth=self.getMaxDepth(), features=self.getMaxFeatures())
        grow = _fit_sampled if size <= IN_TASK_SAMPLE else _fit_levels
        model = IsolationForestModel(grow(data, sampler, **settings).toPandas(), size)
        self._copyValues(model)
        model._training = dataset
        return model


def sampled_rows(data: DataFrame, sampler: Sampler, trees: int) -> DataFrame:
    """(tree, copies, row, x): the sample of every tree, from one scan of a ``placed`` frame."""
    shared = data.sparkSession.sparkContext.broadcast(sampler)
    kind = dict(data.dtypes)["x"]

    def pick(batches):
        rows, tree, copies = shared.value.draws(trees)
        for batch in batches:
            at = shared.value.rows(batch.column("place").to_numpy())
            first, last = np.searchsorted(rows, at), np.searchsorted(rows, at, side="right")
            hit = np.flatnonzero(last > first)
            if not len(hit):
                continue
            count = (last - first)[hit]
            use = np.repeat(first[hit], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            here = pa.array(np.repeat(hit, count))
            yield pa.record_batch(
                [pa.array(tree[use]), pa.array(copies[use]), pa.array(rows[use]), batch.column("x").take(here)],
                ["tree", "copies", "row", "x"],
            )

    return data.mapInArrow(pick, f"tree long, copies long, row long, x {kind}")


def tree_features(seed: int, tree: int, d: int, max_features: float) -> np.ndarray:
    """The features a tree may split on, ascending."""
    return np.sort(np.random.default_rng([seed, tree, 2]).permutation(d)[: subset_size(max_features, d)])


def draw_split(seed: int, tree: int, node: int, features: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[int, float]:
    """Split of a node, by its number in the full binary tree: one of its varying features, a cut within its range.

    Every builder draws here, so they grow the same tree from the same sample.
    """
    rng = np.random.default_rng([seed, tree, 3, node])
    pick = rng.integers(len(features))
    return int(features[pick]), float(rng.random() * (high[pick] - low[pick]) + low[pick])


def build_tree(x: np.ndarray, copies: np.ndarray, depth: int, max_features: float, seed: int, tree: int) -> list[tuple]:
    """One isolation tree as pre-order (id, feature, value, left, right, rows) tuples."""
    limit = min(depth, math.ceil(math.log2(max(2, copies.sum()))))
    nodes: list[list] = []
    stack = [(np.arange(len(x)), 0, 1, -1, False, tree_features(seed, tree, x.shape[1], max_features))]
    while stack:
        rows, level, number, parent, is_right, features = stack.pop()
        here = len(nodes)
        if parent >= 0:
            nodes[parent][4 if is_right else 3] = here
        count = int(copies[rows].sum())
        split = None
        if level < limit and count > 1 and len(features):
            low, high = x[np.ix_(rows, features)].min(axis=0), x[np.ix_(rows, features)].max(axis=0)
            varies = low < high
            features = features[varies]
            if len(features):
                split = draw_split(seed, tree, number, features, low[varies], high[varies])
        if split is None:
            nodes.append([here, -1, -1.0, -1, -1, count])
            continue
        nodes.append([here, split[0], split[1], -1, -1, 0])
        goes_left = x[rows, split[0]] < split[1]
        stack.append((rows[~goes_left], level + 1, 2 * number + 1, here, True, features))
        stack.append((rows[goes_left], level + 1, 2 * number, here, False, features))
    return [tuple(n) for n in nodes]


def _fit_sampled(data, sampler, trees, depth, features):
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row")
        tree = int(pdf["tree"].iloc[0])
        nodes = build_tree(np.stack(pdf["x"].to_numpy()), pdf["copies"].to_numpy(), depth, features, sampler.seed, tree)
        frame = pd.DataFrame(nodes, columns=NODE_SCHEMA.names[1:])
        frame.insert(0, "treeID", tree)
        return frame

    return sampled_rows(data, sampler, trees).groupBy("tree").applyInPandas(build, NODE_SCHEMA)


def _fit_levels(data, sampler, trees, depth, features):
    spark = data.sparkSession
    seed = sampler.seed
    shared = spark.sparkContext.broadcast(sampler)
    limit = min(depth, math.ceil(math.log2(max(2, sampler.size))))
    d = len(data.first()["x"])
    rows = data.select("x", "place")
    # Heap numbering: node n has children 2n and 2n+1. Size is bounded by trees * 2^limit.
    splits: list[dict[int, tuple[int, float]]] = [{} for _ in range(trees)]
    frontier: list[set[int]] = [{1} for _ in range(trees)]
    counts: list[dict[int, int]] = [{} for _ in range(trees)]
    for level in range(limit + 1):
        if not any(frontier):
            break
        width = 1 << level
        feature, value = np.full((trees, width), -1, dtype=np.int32), np.zeros((trees, width))
        for tree, chosen_splits in enumerate(splits):
            for node, (f, v) in chosen_splits.items():
                feature[tree, node], value[tree, node] = f, v
        state = spark.sparkContext.broadcast((feature, value, [bool(f) for f in frontier]))

        def measure(batches, state=state, level=level, width=width):
            feature, value, growing = state.value
            low = {}
            for batch in batches:
                x, ids = matrix(batch.column(0)), shared.value.rows(batch.column(1).to_numpy())
                for tree in range(trees):
                    if not growing[tree]:
                        continue
                    copies = shared.value.copies(tree, ids)
                    at = np.flatnonzero(copies)
                    node = np.ones(len(at), dtype=np.int64)
                    # Rows that stopped in an earlier leaf keep a number below the level's width.
                    for _ in range(level):
                        inside = np.minimum(node, width - 1)
                        f = np.where(node < width, feature[tree][inside], -1)
                        left = x[at, np.maximum(f, 0)] < value[tree][inside]
                        node = np.where(f >= 0, 2 * node + np.where(left, 0, 1), node)
                    if tree not in low:
                        low[tree] = [np.full((width, d), np.inf), np.full((width, d), -np.inf), np.zeros(width, dtype=np.int64)]
                    current = node >= width
                    slot = node[current] - width
                    if not len(slot):
                        continue
                    by_slot = np.argsort(slot, kind="stable")
                    slot, kept = slot[by_slot], at[current][by_slot]
                    starts = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
                    used = slot[starts]
                    lo, hi, n = low[tree]
                    lo[used] = np.minimum(lo[used], np.minimum.reduceat(x[kept], starts, axis=0))
                    hi[used] = np.maximum(hi[used], np.maximum.reduceat(x[kept], starts, axis=0))
                    n[used] += np.add.reduceat(copies[kept], starts)
            for tree, (lo, hi, n) in low.items():
                used = np.flatnonzero(n)
                yield pa.RecordBatch.from_pydict(
                    {
                        "tree": np.full(len(used) * d, tree, dtype=np.int32), "node": np.repeat(used + width, d).astype(np.int32),
                        "feature": np.tile(np.arange(d, dtype=np.int32), len(used)), "low": lo[used].ravel(),
                        "high": hi[used].ravel(), "n": np.repeat(n[used], d),
                    }
                )

        partial = rows.mapInArrow(measure, "tree int, node int, feature int, low double, high double, n long")
        folded = partial.groupBy("tree", "node", "feature").agg(
            F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")
        )

        def choose(pdf: pd.DataFrame) -> pd.DataFrame:
            tree = int(pdf["tree"].iloc[0])
            usable = tree_features(seed, tree, d, features)
            out = []
            for node, part in pdf.sort_values("feature").groupby("node"):
                n = int(part["n"].iloc[0])
                open_ = part[part["feature"].isin(usable) & (part["low"] < part["high"])]
                if level >= limit or n <= 1 or not len(open_):
                    out.append((tree, node, -1, -1.0, n))
                    continue
                split = draw_split(seed, tree, int(node), *[open_[c].to_numpy() for c in ("feature", "low", "high")])
                out.append((tree, node, *split, n))
            return pd.DataFrame(out, columns=["tree", "node", "feature", "value", "n"])

        picked = folded.groupBy("tree").applyInPandas(choose, "tree int, node int, feature int, value double, n long").collect()
        frontier = [set() for _ in range(trees)]
        for r in picked:
            if r["feature"] < 0:
                counts[r["tree"]][r["node"]] = r["n"]
            else:
                splits[r["tree"]][r["node"]] = (r["feature"], r["value"])
                frontier[r["tree"]] |= {2 * r["node"], 2 * r["node"] + 1}
        state.unpersist()
    out = []
    for tree in range(trees):
        order: dict[int, int] = {}
        stack = [1]
        while stack:
            node = stack.pop()
            order[node] = len(order)
            if node in splits[tree]:
                stack += [2 * node + 1, 2 * node]
        for node, at in order.items():
            if node in splits[tree]:
                f, v = splits[tree][node]
                out.append((tree, at, f, float(v), order[2 * node], order[2 * node + 1], 0))
            else:
                out.append((tree, at, -1, -1.0, -1, -1, counts[tree].get(node, 0)))
    return spark.createDataFrame(out, NODE_SCHEMA)


class ForestArrays:
    """All trees as flat arrays; leaves point to themselves so that walking needs no masks."""

    def __init__(self, nodes: pd.DataFrame):
        nodes = nodes.sort_values(["treeID", "id"]).reset_index(drop=True)
        tree = nodes["treeID"].to_numpy()
        self.roots = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]]).astype(np.int32)
        base = self.roots[np.searchsorted(np.unique(tree), tree)]
        here = np.arange(len(nodes), dtype=np.int32)
        leaf = nodes["featureIndex"].to_numpy() < 0
        self.feature = np.where(leaf, 0, nodes["featureIndex"]).astype(np.int32)
        self.value = nodes["featureValue"].to_numpy()
        self.children = np.empty(2 * len(nodes), dtype=np.int32)
        self.children[0::2] = np.where(leaf, here, base + nodes["rightChild"])
        self.children[1::2] = np.where(leaf, here, base + nodes["leftChild"])
        depth = np.zeros(len(nodes), dtype=int)
        for i in np.flatnonzero(~leaf):
            depth[self.children[2 * i : 2 * i + 2]] = depth[i] + 1
        self.steps = int(depth.max(initial=0))
        self.path = np.where(leaf, depth + path_correction(nodes["numInstance"]), 0.0)

    def plain(self) -> tuple:
        """Arrays only, for broadcasting."""
        return self.roots, self.feature, self.value, self.children, self.path, self.steps


def mean_path(forest: tuple, x: np.ndarray, block: int = 512) -> np.ndarray:
    """Mean path length over all trees, a block of rows at a time so that it stays in cache."""
    roots, feature, value, children, path, steps = forest
    out = np.empty(len(x))
    for start in range(0, len(x), block):
        part = np.ascontiguousarray(x[start : start + block])
        offset = (np.arange(len(part)) * part.shape[1])[:, None]
        flat = part.ravel()
        node = np.repeat(roots[None, :], len(part), axis=0)
        for _ in range(steps):
            left = flat.take(feature.take(node) + offset) < value.take(node)
            node = children.take(2 * node + left)
        out[start : start + block] = path.take(node).mean(axis=1)
    return out


class IsolationForestModel(_ForestParams, Model, MLReadable, MLWritable):
    """Fitted forest. ``nodes`` is a pandas table bounded by trees and height."""

    def __init__(self, nodes: pd.DataFrame | None = None, sample_size: int = 0):
        super().__init__()
        self._forest_defaults()
        self.nodes = nodes
        self.sample_size = sample_size
        self._threshold = -1.0
        self._training: DataFrame | None = None
        self._arrays: ForestArrays | None = None

    @property
    def trees(self) -> int:
        return int(self.nodes["treeID"].nunique())

    def score_column(self, dataset: DataFrame) -> Column:
        if self._arrays is None:
            self._arrays = ForestArrays(self.nodes)
        shared = dataset.sparkSession.sparkContext.broadcast(self._arrays.plain())
        size = self.sample_size
        if self.getNorm() == "dataset" and self.getMaxSamples() <= 1:
            size = self.getMaxSamples() * dataset.count()
        norm = float(path_correction(size))

        @F.arrow_udf(T.DoubleType())
        def score(x: pa.Array) -> pa.Array:
            def run(rows):
                return np.exp2(-mean_path(shared.value, rows) / norm) if norm > 0 else np.full(len(rows), 0.5)

            return per_row(x, run)

        return score(feature_array(dataset, self.getFeaturesCol()))

    def _score(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getAnomalyScoreCol(), self.score_column(dataset))

    def getThreshold(self) -> float:
        """Score above which rows are outliers; taken from the training scores on first use."""
        if self._threshold < 0:
            if self._training is None:
                raise ValueError("no threshold stored: call setThreshold or fit_threshold first")
            self.fit_threshold(self._training)
        return self._threshold

    def setThreshold(self, value: float):
        self._threshold = float(value)
        return self

    def fit_threshold(self, dataset: DataFrame):
        """Threshold at the (1 - contamination) quantile of the scores of ``dataset``."""
        scores = self._score(dataset).select(self.getAnomalyScoreCol())
        share, error = 1 - self.getContamination(), self.getApproxQuantileRelativeError()
        return self.setThreshold(rank_quantile(scores, self.getAnomalyScoreCol(), share, error).first()[0])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if self._threshold < 0 and self._training is None:
            self.fit_threshold(dataset)
        flag = F.when(F.col(self.getAnomalyScoreCol()) > self.getThreshold(), 1.0).otherwise(0.0)
        return self._score(dataset).withColumn(self.getPredictionCol(), flag)

    def score_samples(self, dataset: DataFrame, sign: int = 1) -> DataFrame:
        """Scores without a prediction; ``sign=-1`` gives the convention where low is abnormal."""
        return dataset.withColumn(self.getAnomalyScoreCol(), self.score_column(dataset) * sign)

    @property
    def hasSummary(self) -> bool:
        return self._training is not None

    @property
    def summary(self) -> "ForestSummary":
        if not self.hasSummary:
            raise RuntimeError("this model was loaded or copied: the data it was trained on is not known")
        return ForestSummary(self, self._training)

    def write(self):
        return _ModelWriter(self)

    @classmethod
    def read(cls):
        return _ModelReader(cls)


class ForestSummary:
    """Training predictions, as lazy frames."""

    def __init__(self, model: IsolationForestModel, training: DataFrame):
        self.predictions = model.transform(training)
        self._model = model

    @property
    def anomalies(self) -> DataFrame:
        return self.predictions.select(self._model.getPredictionCol())

    @property
    def anomalyScores(self) -> DataFrame:
        return self.predictions.select(self._model.getAnomalyScoreCol())

    @property
    def numAnomalies(self) -> int:
        return int(self.predictions.agg(F.sum(self._model.getPredictionCol())).first()[0])


class _ModelWriter(MLWriter):
    def __init__(self, model):
        super().__init__()
        self.model = model

    def saveImpl(self, path):
        model, spark = self.model, self.sparkSession
        extra = {"sampleSize": model.sample_size, "threshold": model._threshold}
        if model._threshold < 0 and model._training is not None:
            extra["threshold"] = model.getThreshold()
        DefaultParamsWriter.saveMetadata(model, path, spark, extraMetadata=extra)
        spark.createDataFrame(model.nodes, NODE_SCHEMA).write.parquet(f"{path}/data")


class _ModelReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path):
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        nodes = spark.read.schema(NODE_SCHEMA).parquet(f"{path}/data").orderBy("treeID", "id").toPandas()
        model = self.cls(nodes, metadata["sampleSize"])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model.setThreshold(metadata["threshold"])
