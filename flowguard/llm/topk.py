"""Exact top-k inner products by sorted access only (no random access).

Vectors are dealt into blocks by a hash of their id, so that every block is a fair part of the table and fits one task.
A block keeps one list per dimension, sorted by coordinate. A query reads the lists from the end its own sign prefers, a
stretch of every list per round, and keeps for each vector the sum of the read products, a lower bound (unread
coordinates at their list's worst value) and an upper bound (unread coordinates at the list's current value). Vectors
whose upper bound is below the k-th largest lower bound, here or in the blocks the task has read before, are out. Reading
stops when few vectors are left; their final scores are then resolved. Each task's k best meet in one ranking per query.
Queries of a block read together: what a round reads is then a product of matrices.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowguard.llm.registry import query, table

BLOCK_ROWS, QUERY_ROWS = 4096, 512
GROUP_BLOCKS = 3  # blocks that a task reads one after the other
DEPTHS = (0.375, 0.5, 0.625, 0.75, 0.875, 1.0)
FEW = 4  # a query stops reading when a quarter of the vectors is left


class Block:
    """Sorted lists over the vectors of one block; ``rank`` is a vector's place in the list of each dimension."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x, self.n = ids, x, len(x)
        self.values = x.astype(np.float64)
        lists = np.argsort(x, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.values, lists, axis=0)
        self.rank = np.empty_like(lists)
        np.put_along_axis(self.rank, lists, np.arange(self.n)[:, None], axis=0)

    def bounds(self, q: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """(lower, upper) bounds of all vectors (rows) for the queries (columns) after ``depth`` reads of every list."""
        n, parts = self.n, []
        for down in (True, False):
            sign = np.where((q > 0) == down, q, 0.0).T  # dimensions read from this end
            read = (self.rank >= n - depth if down else self.rank < depth).astype(np.float64)
            worst = self.sorted[0 if down else -1][:, None] * sign
            front = worst if depth == n else self.sorted[n - 1 - depth if down else depth][:, None] * sign
            seen = (read * self.values) @ sign
            parts.append((seen + worst.sum(axis=0) - read @ worst, seen + front.sum(axis=0) - read @ front))
        return parts[0][0] + parts[1][0], parts[0][1] + parts[1][1]

    def read(self, query_ids: np.ndarray, q: np.ndarray, k: int, floor: np.ndarray) -> list[np.ndarray]:
        """Rows that may be among the k best of each query, by reading the lists in rounds.

        ``floor`` holds scores that k other vectors are known to reach, or -inf.
        """
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(q)
        open_ = np.arange(len(q))
        for share in DEPTHS:
            depth = min(self.n, max(1, int(self.n * share)))
            low, high = self.bounds(q[open_].astype(np.float64), depth)
            own = self.ids[:, None] == query_ids[open_][None, :]
            low[own] = high[own] = -np.inf
            least = floor[open_]
            if self.n > k:
                least = np.maximum(least, np.partition(low, self.n - k, axis=0)[self.n - k])
            alive = (high >= least - 0.5) & ~own  # scores are whole numbers
            done = (alive.sum(axis=0) <= max(4 * k, self.n // FEW)) | (depth == self.n)
            for j in np.flatnonzero(done):
                out[open_[j]] = np.flatnonzero(alive[:, j])
            open_ = open_[~done]
            if not len(open_):
                break
        return out


def best_of(query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> pd.DataFrame:
    """(query_id, vec_id, score) of each query's k best vectors but its own, ties to the smaller id."""
    best_ids = [np.zeros(0, np.int64)] * len(q)
    best = [np.zeros(0, np.int64)] * len(q)
    for at in range(0, len(ids), BLOCK_ROWS):
        block = Block(ids[at : at + BLOCK_ROWS], x[at : at + BLOCK_ROWS])
        floor = np.array([s[-1] if len(s) == k else -np.inf for s in best], np.float64)
        for i, rows in enumerate(block.read(query_ids, q, k, floor)):
            score = np.concatenate([best[i], block.x[rows] @ q[i]])
            named = np.concatenate([best_ids[i], block.ids[rows]])
            top = np.lexsort((named, -score))[:k]
            best[i], best_ids[i] = score[top], named[top]
    return pd.DataFrame({"query_id": np.repeat(query_ids, [len(s) for s in best]), "vec_id": np.concatenate(best_ids), "score": np.concatenate(best)})


def integer_vector(x: Column) -> Column:
    """floor(1024 * x) of every component; null if the vector or a component is null or not finite."""
    wide = F.transform(x, lambda v: v.cast("double"))
    bad = F.exists(wide, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(~bad, F.transform(wide, lambda v: F.floor(1024 * v).cast("long")))


def top_k(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k best candidates; both frames have (id long, x array<long>).

    Candidates with the query's own id are left out; null vectors and null ids take no part; vectors of another length
    than the query's are no candidates. A query without candidates has no rows. Equal vectors under different ids are
    candidates of their own, ties go to the smaller id; a repeated query row asks once, a repeated candidate row counts
    once. Components are expected to stay below 2**26, so that sums of products are exact.
    """
    clean = [
        f.filter("id IS NOT NULL AND x IS NOT NULL").select("id", "x").dropDuplicates().withColumn("dim", F.size("x")) for f in (queries, candidates)
    ]
    n_queries, n_rows = (f.count() for f in clean)
    q_blocks, c_blocks = max(1, -(-n_queries // QUERY_ROWS)), max(1, -(-n_rows // (BLOCK_ROWS * GROUP_BLOCKS)))
    asked, held = (
        f.select("dim", F.pmod(F.xxhash64("id"), F.lit(n)).alias(name), "id", "x")
        for f, n, name in ((clean[0], q_blocks, "qb"), (clean[1], c_blocks, "cb"))
    )
    # Every query block meets every candidate block once: rows move, pairs do not.
    asked = asked.withColumn("cb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(c_blocks - 1).cast("long"))))
    held = held.withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(q_blocks - 1).cast("long"))))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        q, x = (np.stack(f["x"].to_list()).astype(np.int64) for f in (left, right))
        return best_of(left["id"].to_numpy(np.int64), q, right["id"].to_numpy(np.int64), x, k)

    key = ["dim", "qb", "cb"]
    found = asked.groupBy(*key).cogroup(held.groupBy(*key)).applyInPandas(meet, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


OP10_SQL = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.x AS DOUBLE[]), CAST(c.x AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.x) = len(q.x) WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query("op10_sorted_access_top_k", OP10_SQL)
def op10_sorted_access_top_k(spark, folder):
    rows = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), integer_vector(F.col("embedding")).alias("x"))
    return top_k(rows.filter(F.col("id") % 100 == 0), rows, 10)
