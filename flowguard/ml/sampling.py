"""Exact random samples of stored rows, computable row by row.

Rows get a dense number once. A sample without replacement holds the rows that a seeded permutation sends below the sample
size; with replacement, draws are dealt to runs of rows by a multinomial and to rows inside their run. Both can be listed (for
small samples) or asked for given rows (for large ones), with the same answer.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.session import checkpointed

RUN = 1 << 16
ROUNDS = 6


def placed(df: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """The frame, stored once with ``place``, and where each partition's rows begin in a dense numbering.

    ``place`` is written with the rows, so it means the same row in every later scan, however Spark splits the files.
    The last of the returned numbers is the number of rows.
    """
    kept = checkpointed(df.withColumn("place", F.monotonically_increasing_id()))
    found = kept.groupBy(F.shiftright("place", 33).alias("part")).count().collect()  # one row per partition
    sizes = np.zeros(max((r["part"] for r in found), default=-1) + 1, np.int64)
    for r in found:
        sizes[r["part"]] = r["count"]
    return kept, np.concatenate([[0], np.cumsum(sizes)])


def mix(values: np.ndarray) -> np.ndarray:
    """64-bit integer mixer."""
    z = values + np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


class Sampler:
    """Samples of ``size`` of the rows numbered 0 to starts[-1] - 1, one per tree."""

    def __init__(self, starts: np.ndarray, size: int, bootstrap: bool, seed: int):
        self.starts, self.total, self.size = starts, int(starts[-1]), size
        self.bootstrap, self.seed = bootstrap, seed
        self.half = max(1, ((self.total - 1).bit_length() + 1) // 2)
        self._runs: dict[int, np.ndarray] = {}

    def rows(self, place: np.ndarray) -> np.ndarray:
        """Dense row numbers of stored places."""
        return self.starts[place >> 33] + (place & ((1 << 33) - 1))

    def _shuffle(self, tree: int, rows: np.ndarray, back: bool) -> np.ndarray:
        keys = mix(np.arange(ROUNDS, dtype=np.uint64) + np.uint64((self.seed * 1_000_003 + tree) % (1 << 64)))
        bits, mask = np.uint64(self.half), np.uint64((1 << self.half) - 1)

        def step(x):
            left, right = x >> bits, x & mask
            for key in keys[::-1] if back else keys:
                if back:
                    left, right = right ^ (mix(left + key) & mask), left
                else:
                    left, right = right, left ^ (mix(right + key) & mask)
            return (left << bits) | right

        out = step(rows.astype(np.uint64))
        while (far := np.flatnonzero(out >= np.uint64(self.total))).size:
            out[far] = step(out[far])
        return out.astype(np.int64)

    def _in_runs(self, tree: int) -> np.ndarray:
        """Draws with replacement that fall into each run of RUN rows."""
        if tree not in self._runs:
            edges = np.append(np.arange(0, self.total, RUN), self.total)
            share = np.diff(edges) / self.total
            self._runs[tree] = np.random.default_rng([self.seed, tree]).multinomial(self.size, share / share.sum())
        return self._runs[tree]

    def _run_copies(self, tree: int, run: int) -> np.ndarray:
        length = min(RUN, self.total - run * RUN)
        drawn = np.random.default_rng([self.seed, tree, run]).integers(0, length, self._in_runs(tree)[run])
        return np.bincount(drawn, minlength=length)

    def draws(self, trees: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rows, trees, copies) of all samples, in row order: for samples that fit a task."""
        rows, tree, copies = [], [], []
        for t in range(trees):
            if self.bootstrap:
                for run in np.flatnonzero(self._in_runs(t)):
                    c = self._run_copies(t, int(run))
                    at = np.flatnonzero(c)
                    rows.append(at + run * RUN)
                    copies.append(c[at])
            else:
                rows.append(self._shuffle(t, np.arange(self.size), back=True))
                copies.append(np.ones(self.size, np.int64))
            tree += [t] * (sum(map(len, rows)) - len(tree))
        rows, tree, copies = np.concatenate(rows), np.array(tree, np.int64), np.concatenate(copies)
        order = np.argsort(rows, kind="stable")
        return rows[order], tree[order], copies[order]

    def copies(self, tree: int, rows: np.ndarray) -> np.ndarray:
        """How often each of the given rows is in the sample of a tree."""
        if not self.bootstrap:
            if self.size == self.total:
                return np.ones(len(rows), np.int64)
            return (self._shuffle(tree, rows, back=False) < self.size).astype(np.int64)
        out = np.zeros(len(rows), np.int64)
        run = rows // RUN
        for r in np.unique(run):
            mine = run == r
            if self._in_runs(tree)[r]:
                out[mine] = self._run_copies(tree, int(r))[rows[mine] - r * RUN]
        return out
