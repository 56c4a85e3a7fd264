"""Edge scores from their definitions, over arrays of all events, used to check the distributed scorers.

The clock of an event is the largest slot up to it. A cell is what an event touches: an edge, a source or a destination, or the
hash of one in each sketch row. Every count is a sum over earlier events of the same cell, weighted by a power of the decay
factor in the number of observed slots in between; only the history of the filtering scorer is a recursion over slots.
"""

import numpy as np


def clock(slots):
    """Clock of every event and its rank among the clocks that occur."""
    now = np.maximum.accumulate(np.maximum(slots, 1))
    return now, np.unique(now, return_inverse=True)[1]


def cells(first, second, params, cols):
    """(events x sketch rows) numbers of the touched cells; one column of entity numbers without a sketch."""
    if cols is None:
        return np.unique(np.stack([first, second], axis=1), axis=0, return_inverse=True)[1].reshape(-1, 1)
    half = len(params) // 2
    mixed = first + 347 * second
    return np.stack([(mixed * params[r] + params[r + half]) % cols + r * cols for r in range(half)], axis=1)


def weighted_counts(cell, weight):
    """For every event and column: the sum of weight[i, e] over events e up to i that touch the same cell."""
    upto = np.tril(np.ones((len(cell), len(cell))))
    return np.stack([((c[:, None] == c[None, :]) * upto * weight).sum(axis=1) for c in cell.T], axis=1)


def kinds_of(events, params, cols):
    src, dst, slots = (np.array(x) for x in zip(*events))
    nobody = np.zeros_like(src)
    return slots, [cells(src, dst, params, cols), cells(src, nobody, params, cols), cells(dst, nobody, params, cols)]


def relative(count, total, slot):
    """Squared distance of a count from its share of the total, over the variance that share has."""
    mean = total / slot
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where((total == 0) | (slot == 1), 0.0, (count - mean) ** 2 * slot**2 / (total * (slot - 1)))


def plain(events, params, cols):
    slots, (edge, *_) = kinds_of(events, params, cols)
    now, _ = clock(slots)
    here = weighted_counts(edge, now[:, None] == now[None, :]).min(axis=1)
    ever = weighted_counts(edge, 1.0).min(axis=1)
    return relative(here, ever, slots)


def relational(events, params, cols, factor=0.5):
    slots, kinds = kinds_of(events, params, cols)
    now, rank = clock(slots)
    fade = factor ** np.maximum(rank[:, None] - rank[None, :], 0)
    return np.max([relative(weighted_counts(c, fade).min(axis=1), weighted_counts(c, 1.0).min(axis=1), now) for c in kinds], axis=0)


def history(cell, now, rank, threshold, factor):
    """Scores of one kind: its cells' totals, slot by slot, take in what a slot that ended quietly has counted."""
    count = weighted_counts(cell, factor ** np.maximum(rank[:, None] - rank[None, :], 0))
    total = np.zeros(cell.max() + 1)
    carried, last, out = np.zeros_like(total), np.zeros_like(total), np.zeros(len(cell))
    share, clocks = 0.0, np.unique(now)
    for r, t in enumerate(clocks):
        mine = np.flatnonzero(rank == r)
        if r:
            total += np.where(last < threshold, carried, total * share)
            carried, share = carried * factor, 1 / (t - 1)
        a, s = count[mine].min(axis=1), total[cell[mine]].min(axis=1)
        known = s > 0
        out[mine[known]] = (a[known] + s[known] - a[known] * t) ** 2 / (s[known] * (t - 1))
        for k in range(cell.shape[1]):  # of a cell's events in the slot the last one stays
            carried[cell[mine, k]], last[cell[mine, k]] = count[mine, k], out[mine]
    return out


def filtering(events, params, cols, threshold=1000.0, factor=0.5):
    slots, kinds = kinds_of(events, params, cols)
    now, rank = clock(slots)
    return np.max([history(c, now, rank, threshold, factor) for c in kinds], axis=0)
