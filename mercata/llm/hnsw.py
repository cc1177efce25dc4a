"""A hierarchical navigable small-world graph over one shard's vectors, in flat arrays.

Largest inner product is searched as smallest distance: each vector gets one more component that
makes all lengths equal, a query gets zero there. Nodes are put in by levels from the top, in batches
that see the nodes before them and each other; all searches of a batch walk the graph side by side,
one array operation a step.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LINKS = 16  # per node and upper level; twice as many on level 0
EF_BUILD, EF_SEARCH = 64, 96
STEP = 4  # nodes that a search opens at a time
BATCH = 256


@dataclass
class Graph:
    """``vectors`` (n, d) float32; ``levels``: for each level its nodes and their neighbours
    (nodes, links) as int32, -1 where there is none. Level 0 has all nodes, the last the entry first."""

    vectors: np.ndarray
    levels: list[tuple[np.ndarray, np.ndarray]]

    def search(self, queries: np.ndarray, ef: int = EF_SEARCH) -> np.ndarray:
        """Up to ``ef`` nodes near each query, (queries, ef) with -1 at the end."""
        space = lengthened(self.vectors)
        wide = np.concatenate([queries.astype(np.float32), np.zeros((len(queries), 1), np.float32)], 1)
        out = []
        for i in range(0, len(wide), BATCH):
            part = wide[i : i + BATCH]
            near = np.repeat(self.levels[-1][0][:1][None], len(part), 0)
            for k in range(len(self.levels) - 1, -1, -1):
                nodes, links = self.levels[k]
                near, _ = walk(space, part, near, *_placed(space, nodes, links, k), ef if k == 0 else 1)
            out.append(near)
        return np.concatenate(out) if out else np.empty((0, ef), np.int32)


def lengthened(vectors: np.ndarray) -> np.ndarray:
    squares = np.einsum("ij,ij->i", vectors, vectors, dtype=np.float64)
    rest = np.sqrt(np.maximum(squares.max(initial=0) - squares, 0))
    return np.concatenate([vectors, rest[:, None].astype(np.float32)], 1)


def _placed(space, nodes, links, level):
    if level == 0:
        return (links,)
    full = np.full((len(space), links.shape[1]), -1, np.int32)
    full[nodes] = links
    return (full,)


def distances(space: np.ndarray, queries: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Squared distances of each query to its row of nodes; infinite for -1."""
    found = space[nodes]
    d = np.einsum("ijk,ijk->ij", found, found) - 2 * np.einsum("ijk,ik->ij", found, queries)
    d += np.einsum("ij,ij->i", queries, queries)[:, None]
    return np.where(nodes >= 0, d, np.inf).astype(np.float32)


def walk(space, queries, entries, links, ef) -> tuple[np.ndarray, np.ndarray]:
    """The nearest nodes of each query by best-first search of width ``ef``, and their distances."""
    n, rows = len(queries), np.arange(len(queries))[:, None]
    seen = np.zeros((n, len(space) + 1), bool)  # the last column takes -1
    seen[rows, entries] = True
    seen[:, -1] = True
    ids = np.full((n, ef), -1, np.int32)
    near = np.full((n, ef), np.inf, np.float32)
    done = np.ones((n, ef), bool)
    width = min(ef, entries.shape[1])
    d = distances(space, queries, entries)
    best = np.argsort(d, 1, kind="stable")[:, :width]
    ids[:, :width], near[:, :width] = np.take_along_axis(entries, best, 1), np.take_along_axis(d, best, 1)
    done[:, :width] = ids[:, :width] < 0
    step = min(STEP, ef)
    live = np.flatnonzero((~done).any(1))
    while len(live):
        waiting = np.where(done[live], np.inf, near[live])
        pick = np.argpartition(waiting, step - 1, 1)[:, :step] if step < ef else np.argsort(waiting, 1)[:, :step]
        own = live[:, None]
        opened = np.where(np.take_along_axis(waiting, pick, 1) < np.inf, ids[own, pick], -1)
        done[own, pick] = True
        found = links[opened]
        found[opened < 0] = -1
        found = found.reshape(len(live), -1)
        found[seen[own, found]] = -1
        # The same node may come from two of the opened ones: keep one of each.
        found.sort(1)
        found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
        seen[own, found] = True
        d = distances(space, queries[live], found)
        all_d = np.concatenate([near[live], d], 1)
        all_ids = np.concatenate([ids[live], found], 1)
        all_done = np.concatenate([done[live], found < 0], 1)
        best = np.argpartition(all_d, ef - 1, 1)[:, :ef]
        near[live], ids[live], done[live] = (np.take_along_axis(x, best, 1) for x in (all_d, all_ids, all_done))
        live = live[(~done[live]).any(1)]
    best = np.argsort(near, 1, kind="stable")
    return np.take_along_axis(ids, best, 1), np.take_along_axis(near, best, 1)


def diverse(space: np.ndarray, nodes: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
    """Of each row's nodes, in order of distance, those nearer to the row's own vector than to any
    taken before; filled up with the nearest others. (rows, most), -1 at the end."""
    n, width = nodes.shape
    found = space[nodes]
    squares = np.einsum("ijk,ijk->ij", found, found)
    apart = squares[:, :, None] + squares[:, None, :] - 2 * np.einsum("ijk,ilk->ijl", found, found)
    taken = np.zeros((n, width), bool)
    closest = np.full((n, width), np.inf, np.float32)
    count = np.zeros(n, np.int64)
    for j in range(width):
        good = (nodes[:, j] >= 0) & (near[:, j] < closest[:, j]) & (count < most)
        taken[:, j] = good
        count += good
        closest = np.where(good[:, None], np.minimum(closest, apart[:, :, j]), closest)
    rank = np.where(taken, 0, np.where(nodes >= 0, 1, 2)) * width + np.arange(width)
    order = np.argsort(rank, 1)[:, :most]
    out = np.take_along_axis(nodes, order, 1)
    return out if out.shape[1] == most else np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)


def build(vectors: np.ndarray, seed: int = 0) -> Graph:
    """A graph of the vectors, which should be distinct."""
    vectors = np.ascontiguousarray(vectors, np.float32)
    n, space = len(vectors), lengthened(np.ascontiguousarray(vectors, np.float32))
    chance = np.random.default_rng(seed).random(n)
    level = np.minimum((-np.log(np.maximum(chance, 1e-12)) / np.log(LINKS)).astype(int), 8)
    order = np.argsort(-level, kind="stable").astype(np.int32)
    top = int(level.max(initial=0))
    links = [np.full((n, LINKS * (2 if k == 0 else 1)), -1, np.int32) for k in range(top + 1)]
    entry, put = order[:1], 1
    while put < n:
        # All of a batch on one level, and no larger than what is there.
        high = level[order[put]]
        batch = order[put : put + min(BATCH, put)]
        batch = batch[level[batch] == high]
        own = space[batch]
        near = np.repeat(entry[None], len(batch), 0)
        for k in range(top, -1, -1):
            if k > high:
                near, _ = walk(space, own, near, links[k], 1)
                continue
            near, d = walk(space, own, near, links[k], EF_BUILD)
            beside = np.repeat(batch[None], len(batch), 0)
            between = distances(space, own, beside)
            np.fill_diagonal(between, np.inf)
            nearest = np.argsort(between, 1)[:, :LINKS]
            nodes = np.concatenate([near, np.take_along_axis(beside, nearest, 1)], 1)
            d = np.concatenate([d, np.take_along_axis(between, nearest, 1)], 1)
            nodes = np.where(np.isinf(d), -1, nodes)
            by_d = np.argsort(d, 1, kind="stable")[:, :EF_BUILD]
            nodes, d = np.take_along_axis(nodes, by_d, 1), np.take_along_axis(d, by_d, 1)
            chosen = diverse(space, nodes, d, LINKS)
            links[k][batch, :LINKS] = chosen
            _link_back(space, links[k], batch, chosen)
        put += len(batch)
    levels = []
    for k in range(top + 1):
        nodes = order[level[order] >= k]
        levels.append((nodes, links[k] if k == 0 else links[k][nodes]))
    return Graph(vectors, levels)


def _link_back(space: np.ndarray, links: np.ndarray, batch: np.ndarray, chosen: np.ndarray) -> None:
    """Add the links from the chosen nodes to the batch; full nodes choose again."""
    source = np.repeat(batch, chosen.shape[1])
    target = chosen.reshape(-1)
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    heads = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]])) if len(target) else np.empty(0, int)
    counts = np.diff(np.append(heads, len(target)))
    most = links.shape[1]
    # A node that many choose takes them in rounds of as many as it can hold.
    while len(heads):
        nodes, take = target[heads], np.minimum(counts, most)
        width = int(take.max())
        new = np.full((len(nodes), width), -1, np.int32)
        for j in range(width):
            has = take > j
            new[has, j] = source[heads[has] + j]
        joined = np.concatenate([links[nodes], new], 1)
        joined.sort(1)
        joined[:, 1:][joined[:, 1:] == joined[:, :-1]] = -1
        d = distances(space, space[nodes], joined)
        by_d = np.argsort(d, 1, kind="stable")
        joined, d = np.take_along_axis(joined, by_d, 1), np.take_along_axis(d, by_d, 1)
        full = (joined >= 0).sum(1) > most
        links[nodes[~full]] = joined[~full, :most]
        if full.any():
            links[nodes[full]] = diverse(space, joined[full], d[full], most)
        more = counts > most
        heads, counts = heads[more] + most, counts[more] - most
