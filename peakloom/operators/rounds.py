"""Rounds of linking over the features of one strip of m/z, on arrays inside a task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

REACH = 3  # cells to either side on which one round of a feature depends: its seeds, those around them, what comes before these
PAIRS = 1_000_000  # pairs compared at a time, or those of one feature if it has more


def _places(cells: np.ndarray) -> np.ndarray:
    """Small numbers that are equal where cells are, one apart where they are, and further apart elsewhere."""
    values, at = np.unique(cells, return_inverse=True)
    steps = np.minimum(np.diff(values.view(np.uint64)), np.uint64(2)).astype(np.int64)
    return np.concatenate([[0], np.cumsum(steps)])[at]


def _least(group: np.ndarray, gap: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Places of the least (gap, rank) of each group."""
    order = np.lexsort((rank, gap, group))
    return order[np.concatenate([[True], np.diff(group[order]) != 0])] if len(order) else order


def _pairs(key: np.ndarray, seeds: np.ndarray, row: int):
    """(features, seeds) as places in the two sorted lists of cells, all of a feature in one block: seeds of the nine cells around it."""
    spans = [(np.searchsorted(seeds, key + d - 1, "left"), np.searchsorted(seeds, key + d + 1, "right")) for d in (-row, 0, row)]
    block = np.cumsum(sum(high - low for low, high in spans)) // PAIRS
    for part in np.split(np.arange(len(key)), np.flatnonzero(np.diff(block)) + 1):
        found = []
        for low, high in spans:
            size = high[part] - low[part]
            ends = np.cumsum(size)
            found.append((np.repeat(part, size), np.arange(ends[-1] if len(ends) else 0) + np.repeat(low[part] - ends + size, size)))
        yield tuple(map(np.concatenate, zip(*found)))


def seeds_of(t, m, nth, run, rank, mz, rt, own, ppm: float, window: float, rounds: int) -> np.ndarray:  # noqa: PLR0913
    """The place of every feature's seed, -1 for what no round has reached; it stops when all of ``own`` have one.
    run: a number a run; rank: place in the order of run and identifier."""
    t, m = _places(t), _places(m)
    row = int(t.max(initial=0)) + 3  # so that the last cells of one m/z and the first of the next are not neighbours
    key, seed = m * row + t, np.full(len(t), -1)
    left = np.argsort(key, kind="stable")
    for _ in range(rounds):
        if not own[left].any():
            break
        cells, starts, cell = np.unique(key[left], return_index=True, return_inverse=True)
        least = np.minimum.reduceat(nth[left], starts)
        first = least.copy()
        for d in (-row - 1, -row, -row + 1, -1, 1, row - 1, row, row + 1):
            at = np.minimum(np.searchsorted(cells, cells + d), len(cells) - 1)
            np.minimum(first, least[at], out=first, where=cells[at] == cells + d)
        is_first = nth[left] == first[cell]
        a, s = left[~is_first], left[is_first]
        best, offers = np.full(len(a), -1), []
        for i, j in _pairs(key[a], key[s], row):
            x, y = a[i], s[j]
            gap_mz, gap_rt = np.abs(mz[x] - mz[y]) / mz[y] / (ppm * 1e-6), np.abs(rt[x] - rt[y]) / window
            near = (nth[x] != nth[y]) & (gap_mz <= 1) & (gap_rt <= 1)
            i, x, y, gap = i[near], x[near], y[near], (gap_mz + gap_rt)[near]
            mine = _least(i, gap, rank[y])
            best[i[mine]] = y[mine]
            theirs = _least(y * (run.max() + 1) + run[x], gap, rank[x])
            offers.append((y[theirs], x[theirs], gap[theirs]))
        y, x, gap = map(np.concatenate, zip(*offers))
        theirs = _least(y * (run.max() + 1) + run[x], gap, rank[x])
        wanted = np.full(len(seed), -1)
        wanted[a] = best
        both = theirs[wanted[x[theirs]] == y[theirs]]
        seed[s], seed[x[both]] = s, y[both]
        left = left[seed[left] < 0]
    return seed


def linked(strip: pa.Table, ppm: float, window: float, rounds: int) -> pa.Table:
    """The strip's own features with their seeds' ``seed_run`` and ``seed_id``; ``found`` is false for what is left."""
    column = lambda c: strip[c].to_numpy()
    rank = np.empty(len(strip), np.int64)
    rank[pc.sort_indices(strip, sort_keys=[("run", "ascending"), ("feat_id", "ascending")], null_placement="at_start")] = np.arange(len(strip))
    run = strip["run"].combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
    own = strip["own"].to_numpy()
    with np.errstate(invalid="ignore"):
        seed = seeds_of(column("_t"), column("_m"), column("nth"), run, rank, column("mz"), column("rt"), own, ppm, window, rounds)
    kept = strip.filter(own).drop_columns(["own", "strip"])
    at = pa.array(seed[own], mask=seed[own] < 0)
    for name, c in (("seed_run", "run"), ("seed_id", "feat_id")):
        kept = kept.append_column(name, strip[c].take(at))
    return kept.append_column("found", pa.array(seed[own] >= 0))
