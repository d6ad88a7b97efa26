"""One shard's hierarchical navigable small-world graph as flat neighbour arrays (numpy)."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

LINKS = 12               # neighbours kept on the upper layers; twice as many on the lowest
BUILD_WIDTH = 72         # candidates held while a node is inserted
LEVELS = 4


@dataclass
class Graph:
    unit: np.ndarray            # (n, dim) float32 vectors of length one
    links: list[np.ndarray]     # per layer: (n, width) int32 neighbours, -1 where there is none
    entry: int
    top: int

    def search(self, q: np.ndarray, width: int) -> list[int]:
        """The nodes found nearest to ``q``, at most ``width``."""
        if not len(self.unit):
            return []
        at = [self.entry]
        for layer in range(self.top, 0, -1):
            at = [i for _, i in _search(self.unit, self.links[layer], q, at, 1)]
        return [i for _, i in _search(self.unit, self.links[0], q, at, width)]


def _search(unit, links, q, start, width) -> list[tuple[float, int]]:
    """Best-first search of one layer; (distance, node) ascending."""
    seen = np.zeros(len(unit), dtype=bool)
    seen[start] = True
    open_ = [(1 - float(unit[i] @ q), i) for i in start]
    found = [(-d, i) for d, i in open_]
    heapq.heapify(open_)
    heapq.heapify(found)
    while open_:
        d, i = heapq.heappop(open_)
        if len(found) >= width and d > -found[0][0]:
            break
        near = links[i]
        near = near[near >= 0]
        near = near[~seen[near]]
        if not len(near):
            continue
        seen[near] = True
        for e, j in zip((1 - unit[near] @ q).tolist(), near.tolist()):
            if len(found) < width:
                heapq.heappush(found, (-e, j))
                heapq.heappush(open_, (e, j))
            elif e < -found[0][0]:
                heapq.heapreplace(found, (-e, j))
                heapq.heappush(open_, (e, j))
    return sorted((-d, i) for d, i in found)


def _diverse(unit, found: list[tuple[float, int]], most: int) -> list[int]:
    """Of candidates in ascending distance, those nearer to the node than to any kept
    before; filled up with the nearest others."""
    if len(found) <= most:
        return [i for _, i in found]
    ids = np.array([i for _, i in found])
    between = 1 - unit[ids] @ unit[ids].T
    kept: list[int] = []
    for k, (d, _) in enumerate(found):
        if len(kept) == most:
            break
        if not kept or d < between[k, kept].min():
            kept.append(k)
    if len(kept) < most:
        have = set(kept)
        kept += [k for k in range(len(found)) if k not in have][: most - len(kept)]
    return ids[kept].tolist()


def build(unit: np.ndarray, heights: np.ndarray) -> Graph:
    """Insert the vectors one by one; ``heights`` are uniform numbers in (0, 1) that set the layers."""
    n = len(unit)
    level = np.minimum((-np.log(np.maximum(heights, 1e-12)) / np.log(LINKS)).astype(int), LEVELS - 1)
    links = [np.full((n, LINKS * (2 if k == 0 else 1)), -1, dtype=np.int32) for k in range(LEVELS)]
    graph = Graph(unit, links, 0, int(level[0]) if n else 0)
    for i in range(1, n):
        q, at = unit[i], [graph.entry]
        for layer in range(graph.top, level[i], -1):
            at = [j for _, j in _search(unit, links[layer], q, at, 1)]
        for layer in range(min(graph.top, level[i]), -1, -1):
            found = _search(unit, links[layer], q, at, BUILD_WIDTH)
            at = [j for _, j in found]
            own = _diverse(unit, found, LINKS)
            links[layer][i, : len(own)] = own
            for j in own:
                row = links[layer][j]
                free = np.flatnonzero(row < 0)
                if len(free):
                    row[free[0]] = i
                else:
                    both = np.append(row, i)
                    far = 1 - unit[both] @ unit[j]
                    order = np.argsort(far, kind="stable")
                    row[:] = _diverse(unit, list(zip(far[order].tolist(), both[order].tolist())), len(row))
        if level[i] > graph.top:
            graph.entry, graph.top = i, int(level[i])
    return graph
