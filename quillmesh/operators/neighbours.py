"""Exact nearest neighbours and the spanning tree of mutual reachability by a k-d tree, for points whose matrix fits into a worker."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Points in a leaf at most, leaves in a group, points that are compared with a leaf at once.
LEAF, GROUP, CHUNK = 64, 64, 4096


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean, each row of a with each of b. Equal points have distance 0."""
    if a.shape[1] <= 8:
        d = np.zeros((len(a), len(b)))
        for i in range(a.shape[1]):
            step = a[:, i, None] - b[None, :, i]
            d += step * step
        return np.sqrt(d)
    middle = a.mean(axis=0)
    a, b = a - middle, b - middle
    sizes = (a**2).sum(1)[:, None] + (b**2).sum(1)[None, :]
    d = sizes - 2 * a @ b.T
    i, j = np.nonzero(d < 1e-9 * sizes)  # too few digits are left of these
    for at in range(0, len(i), CHUNK):
        p, q = i[at : at + CHUNK], j[at : at + CHUNK]
        d[p, q] = ((a[p] - b[q]) ** 2).sum(1)
    return np.sqrt(np.maximum(d, 0.0))


def _gap(low: np.ndarray, high: np.ndarray, other_low: np.ndarray, other_high: np.ndarray) -> np.ndarray:
    """The distance of each box from another one."""
    apart = np.maximum(np.maximum(low - other_high, other_low - high), 0.0)
    return np.sqrt((apart * apart).sum(axis=1))


class Tree:
    """Points in the order of the leaves of a k-d tree, with the boxes of leaves and of groups of leaves. order: the row of the matrix that stands at
    each place. Cells are halved by rank, so equal points fill several leaves instead of one large one."""

    def __init__(self, rows: np.ndarray):
        n = len(rows)
        order, starts, todo = np.arange(n), [], [(0, n)]
        while todo:
            start, end = todo.pop()
            if end - start <= LEAF:
                starts.append(start)
                continue
            own = order[start:end]
            cell = rows[own]
            axis, half = int(np.argmax(cell.max(axis=0) - cell.min(axis=0))), (end - start) // 2
            order[start:end] = own[np.argpartition(cell[:, axis], half)]
            todo += [(start + half, end), (start, start + half)]
        self.order, self.points, self.starts = order, rows[order], np.array([*starts, n])
        self.leaves = len(starts)
        self.low, self.high = self.of_leaves(np.minimum, self.points), self.of_leaves(np.maximum, self.points)
        groups = np.arange(0, self.leaves, GROUP)
        self.group_low, self.group_high = np.minimum.reduceat(self.low, groups), np.maximum.reduceat(self.high, groups)

    def of_leaves(self, what: np.ufunc, values: np.ndarray) -> np.ndarray:
        """what (a ufunc that reduces) over the values of each leaf's points."""
        return what.reduceat(values, self.starts[:-1])

    def around(self, leaf: int, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """The leaves whose boxes are at most `reach` from a leaf's box, itself among them, and these distances."""
        low, high = self.low[leaf], self.high[leaf]
        groups = np.flatnonzero(_gap(self.group_low, self.group_high, low, high) <= reach)
        near = (groups[:, None] * GROUP + np.arange(GROUP)).ravel()
        near = near[near < self.leaves]
        gap = _gap(self.low[near], self.high[near], low, high)
        return near[gap <= reach], gap[gap <= reach]

    def chunks(self, leaves: np.ndarray, gap: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
        """The places of the leaves' points, nearest leaves first, and the least distance that any point of this chunk or a later one can have."""
        by = np.argsort(gap, kind="stable")
        leaves, gap = leaves[by], gap[by]
        sizes = self.starts[leaves + 1] - self.starts[leaves]
        ends = np.cumsum(sizes)
        at = 0
        while at < len(leaves):
            before = ends[at] - sizes[at]
            to = max(at + 1, int(np.searchsorted(ends, before + CHUNK, side="right")))
            own = sizes[at:to]
            shift = np.repeat(self.starts[leaves[at:to]] - (ends[at:to] - own - before), own)
            yield np.arange(len(shift)) + shift, gap[at]
            at = to

    def nearest(self, leaf: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """places, distances of the k points nearest to each point of a leaf, itself counted; by distance. There are k points at least."""
        start, end = self.starts[leaf], self.starts[leaf + 1]
        own = self.points[start:end]
        beside = np.arange(max(0, start - k), min(len(self.points), end + k))
        places, found = _least(np.broadcast_to(beside, (len(own), len(beside))), distances(own, self.points[beside]), k)
        if (reach := found[:, -1].max()) > 0:
            places, found = np.full((len(own), k), -1), np.full((len(own), k), np.inf)
            for those, least in self.chunks(*self.around(leaf, reach)):
                live = np.flatnonzero(found[:, -1] > least)
                if not len(live):
                    break
                d = distances(own[live], self.points[those])
                places[live], found[live] = _least(np.hstack([places[live], np.broadcast_to(those, d.shape)]), np.hstack([found[live], d]), k)
        by = np.argsort(found, axis=1, kind="stable")
        return np.take_along_axis(places, by, 1), np.take_along_axis(found, by, 1)

    def outgoing(self, leaves: range, core: np.ndarray, component: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, ...]:
        """component, a, b, d: the shortest edge by mutual reachability from a point a of these leaves to a point b of another component, of each
        component for which one below its bound is found."""
        bound = bound.copy()
        ends = np.full((len(bound), 2), -1, dtype=np.int64)
        low, high = self.of_leaves(np.minimum, component), self.of_leaves(np.maximum, component)
        whole = np.where(low == high, low, -1)
        least_core = self.of_leaves(np.minimum, core)
        for leaf in leaves:
            start, end = self.starts[leaf], self.starts[leaf + 1]
            rows = start + np.flatnonzero(core[start:end] < bound[component[start:end]])
            if not len(rows):
                continue
            near, gap = self.around(leaf, bound[component[rows]].max())
            other = least_core[near] < bound[component[rows]].max()
            if whole[leaf] >= 0:
                other &= whole[near] != whole[leaf]
            near, gap = near[other], gap[other]
            if len(near) > 8:  # the nearest leaf first: it may rule out most others
                first = int(np.argmin(gap))
                self._shorten(near[[first]], gap[[first]], rows, core, component, bound, ends)
                rest = gap < bound[component[rows]].max()
                rest[first] = False
                near, gap = near[rest], gap[rest]
            self._shorten(near, gap, rows, core, component, bound, ends)
        found = np.flatnonzero(ends[:, 0] >= 0)
        return found, ends[found, 0], ends[found, 1], bound[found]

    def _shorten(self, leaves: np.ndarray, gap: np.ndarray, rows: np.ndarray, core: np.ndarray, component: np.ndarray, bound: np.ndarray, ends: np.ndarray) -> None:
        """Edges from the points at `rows` to points of the leaves that are shorter than the bounds of their components take their place."""
        for those, least in self.chunks(leaves, gap):
            most = bound[component[rows]]
            rows = rows[(core[rows] < most) & (least < most)]
            if not len(rows):
                return
            d = np.maximum(np.maximum(distances(self.points[rows], self.points[those]), core[rows][:, None]), core[those][None, :])
            own = component[rows]
            d[own[:, None] == component[those][None, :]] = np.inf
            j = d.argmin(axis=1)
            best = d[np.arange(len(rows)), j]
            better = np.flatnonzero(best < bound[own])
            better = better[np.lexsort((best[better], own[better]))]
            better = better[np.r_[True, own[better][1:] != own[better][:-1]][: len(better)]]
            bound[own[better]] = best[better]
            ends[own[better], 0], ends[own[better], 1] = rows[better], those[j[better]]


def _least(places: np.ndarray, d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k smallest of each row."""
    by = np.argpartition(d, k - 1, axis=1)[:, :k]
    return np.take_along_axis(places, by, 1), np.take_along_axis(d, by, 1)


def shortest(component: np.ndarray, edge: np.ndarray, d: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """edge, d of the shortest edge of each component 0 .. count - 1; -1 and infinity where there is none."""
    by = np.lexsort((d, component))
    by = by[np.r_[True, component[by][1:] != component[by][:-1]][: len(by)]]
    best, length = np.full(count, -1), np.full(count, np.inf)
    best[component[by]], length[component[by]] = edge[by], d[by]
    return best, length


def joined(component: np.ndarray, a: np.ndarray, b: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The components after edges from a to b, taken in the order given unless they close a circle, numbered from 0; which edges were taken."""
    root = list(range(count))
    taken = np.zeros(len(a), dtype=bool)
    for i, (x, y) in enumerate(zip(component[a].tolist(), component[b].tolist(), strict=True)):
        while root[x] != x:
            root[x] = x = root[root[x]]
        while root[y] != y:
            root[y] = y = root[root[y]]
        if x != y:
            root[max(x, y)] = min(x, y)
            taken[i] = True
    up = np.array(root)
    while (up[up] != up).any():
        up = up[up]
    return np.unique(up, return_inverse=True)[1][component], taken
