"""Robust-pruned directed graph over the vectors of one shard, searched by beams.

Points enter in growing batches, of 128 at most. A greedy beam search through the graph so far
proposes neighbours, and so do the nearest points of the same batch, which isn't in the graph yet; of these, in order of distance, one is kept unless an already
kept neighbour is nearer to it than ``alpha`` times shorter than the point itself
(relaxed pruning), which leaves a few near and some far-reaching edges. Kept
neighbours get an edge back and are pruned again where they have too many. All
points of a batch, and all queries, go through the graph in step, so the work is
done in whole-array operations.
"""

from __future__ import annotations

import numpy as np


def beam_search(
    points: np.ndarray, edges: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int, width: int = 4
) -> tuple[np.ndarray, np.ndarray]:
    """(ids, squared distances) of the ``beam`` nearest points found for each query, nearest first.

    points: n x d unit vectors; edges: n x r neighbour numbers, -1 where absent
    entry: queries x e starting points; width: points expanded per step
    """
    rows, n = len(queries), len(points)
    seen = np.zeros((rows, n + 1), bool)
    seen[:, n] = True  # absent neighbours
    ids = np.full((rows, beam), n, np.int64)
    far = np.full((rows, beam), np.inf, np.float32)
    done = np.ones((rows, beam), bool)
    r = np.arange(rows)
    fresh = entry
    active = r
    while len(active):
        # distances of unseen points; a point listed twice in one step counts once
        if fresh.shape[1] > 1:
            fresh = np.sort(fresh, axis=1)
            fresh[:, 1:][fresh[:, 1:] == fresh[:, :-1]] = n
        new = ~seen[active[:, None], fresh]
        fresh = np.where(new, fresh, n)
        seen[active[:, None], fresh] = True
        near = points[np.minimum(fresh, n - 1)]
        dist = 2.0 - 2.0 * np.matmul(near, queries[active][:, :, None])[:, :, 0]
        dist[~new] = np.inf
        all_far = np.concatenate([far[active], dist], axis=1)
        all_ids = np.concatenate([ids[active], fresh], axis=1)
        all_done = np.concatenate([done[active], ~new], axis=1)
        if all_far.shape[1] > beam:
            best = np.argpartition(all_far, beam - 1, axis=1)[:, :beam]
            all_far, all_ids, all_done = (np.take_along_axis(x, best, 1) for x in (all_far, all_ids, all_done))
        far[active], ids[active], done[active] = all_far, all_ids, all_done
        cost = np.where(all_done, np.inf, all_far)
        going = np.isfinite(cost).any(axis=1)
        active, cost = active[going], cost[going]
        if not len(active):
            break
        step = min(width, beam)
        pick = np.argpartition(cost, step - 1, axis=1)[:, :step] if step < beam else np.tile(np.arange(beam), (len(active), 1))
        ok = np.isfinite(np.take_along_axis(cost, pick, 1))
        chosen = np.where(ok, ids[active[:, None], pick], n)
        mark = done[active]
        np.put_along_axis(mark, pick, True, 1)
        done[active] = mark
        fresh = np.where(ok[:, :, None], edges[np.minimum(chosen, n - 1)], n).reshape(len(active), -1)
        fresh = np.where(fresh < 0, n, fresh)
    order = np.argsort(far, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(far, order, 1)


def robust_prune(points: np.ndarray, owner: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Neighbours (rows x degree, -1 where fewer) kept of the candidates of each owner.

    cand: rows x c point numbers, -1 for none; the owner itself and repeats are left out
    """
    n = len(points)
    cand = np.sort(np.where((cand < 0) | (cand == owner[:, None]), n, cand), axis=1)
    cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = n
    near = points[np.minimum(cand, n - 1)]
    dist = 2.0 - 2.0 * np.matmul(near, points[owner][:, :, None])[:, :, 0]
    dist[cand == n] = np.inf
    order = np.argsort(dist, axis=1, kind="stable")
    dist = np.take_along_axis(dist, order, 1)
    cand = np.take_along_axis(cand, order, 1)
    near = np.take_along_axis(near, order[:, :, None], 1)
    between = 2.0 - 2.0 * np.matmul(near, near.transpose(0, 2, 1))
    out = np.full((len(owner), degree), -1, np.int64)
    count = np.zeros(len(owner), np.int64)
    alive = np.isfinite(dist)
    r = np.arange(len(owner))
    while True:
        go = alive.any(axis=1) & (count < degree)
        if not go.any():
            return out
        own = r[go]
        first = alive[own].argmax(axis=1)
        out[own, count[own]] = cand[own, first]
        count[own] += 1
        covered = alpha * between[own, first] <= dist[own]
        still = alive[own] & ~covered
        still[np.arange(len(own)), first] = False
        alive[own] = still


def build(points: np.ndarray, degree: int = 24, beam: int = 32, alpha: float = 1.2, batch: int = 128) -> tuple[np.ndarray, int]:
    """(edges, medoid) of the graph over the points."""
    n = len(points)
    centre = points.mean(axis=0)
    medoid = int(np.argmax(points @ centre)) if n else 0
    edges = np.full((n, degree), -1, np.int64)
    order = np.random.default_rng(7).permutation(n)
    order = np.concatenate([[medoid], order[order != medoid]]).astype(np.int64)
    start, size = 1, 16
    while start < n:
        own = order[start : start + size]
        found, _ = beam_search(points, edges, points[own], np.full((len(own), 1), medoid), beam)
        found = np.where(found >= n, -1, found)
        # the batch itself is not in the graph yet: neighbours within it are proposed as well
        if len(own) > 1:
            inner = points[own] @ points[own].T
            np.fill_diagonal(inner, -np.inf)
            k = min(8, len(own) - 1)
            found = np.concatenate([found, own[np.argpartition(-inner, k - 1, axis=1)[:, :k]]], axis=1)
        edges[own] = robust_prune(points, own, found, degree, alpha)
        _add_back(points, edges, own, degree, alpha)
        start += len(own)
        size = min(batch, size * 2)
    return edges, medoid


def _add_back(points: np.ndarray, edges: np.ndarray, own: np.ndarray, degree: int, alpha: float) -> None:
    """Give every neighbour of ``own`` an edge back, pruning where the degree is exceeded."""
    source = np.repeat(own, degree)
    target = edges[own].ravel()
    source, target = source[target >= 0], target[target >= 0]
    # the nearest new edges of a target come first, and no more of them than two degrees are weighed
    dist = -np.einsum("ij,ij->i", points[source], points[target])
    order = np.lexsort((dist, target))
    source, target = source[order], target[order]
    new = np.ones(len(target), bool)
    new[1:] = target[1:] != target[:-1]
    first = np.flatnonzero(new)
    group = np.add.accumulate(new) - 1
    place = np.arange(len(target)) - first[group]
    room = 2 * degree
    extra = np.full((len(first), min(room, int(place.max(initial=0)) + 1)), -1, np.int64)
    fit = place < room
    extra[group[fit], place[fit]] = source[fit]
    heads = target[first]
    merged = np.concatenate([edges[heads], extra], axis=1)
    crowded = (merged >= 0).sum(axis=1) > degree
    if crowded.any():
        edges[heads[crowded]] = robust_prune(points, heads[crowded], merged[crowded], degree, alpha)
    easy = merged[~crowded]
    edges[heads[~crowded]] = -np.sort(-easy, axis=1)[:, :degree]
