"""A robust-pruned directed graph over the vectors of one shard, built and searched in batches with numpy."""

from __future__ import annotations

import numpy as np


class Graph:
    """Vectors with an edge list each; greedy searches from ``start`` reach those with the largest inner products.

    The graph is built over directions: vectors are cut to length one, where the nearest point by Euclidean distance is
    the one with the largest inner product, and edges go to neighbours in all directions, whatever the lengths are. A
    search follows the same edges by the inner products of the vectors themselves.
    """

    def __init__(self, vectors: np.ndarray, edges: np.ndarray, start: int, alpha: float = 1.2):
        self.x = np.ascontiguousarray(vectors, dtype=np.float32)
        # What is taken for the squared length of a point: nothing when inner products alone count.
        self.square = np.zeros(len(self.x), dtype=np.float32)
        self.edges, self.start, self.alpha = edges, start, alpha
        self.degree = edges.shape[1]

    @classmethod
    def build(cls, vectors: np.ndarray, degree: int = 32, beam: int = 64, alpha: float = 1.2, batch: int = 512) -> Graph:
        """Insert the vectors in batches, in a fixed random order, from the one nearest to the mean on.

        The first batch is connected from all its distances, later ones from searches of the graph so far.
        """
        n = len(vectors)
        units = vectors / np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))[:, None]
        graph = cls(units, np.full((n, degree), -1, dtype=np.int32), 0, alpha)
        graph.square[:] = 1
        graph.start = int((graph.square - 2 * graph.x @ graph.x.mean(axis=0)).argmin())
        order = np.random.default_rng(0).permutation(n)
        order = np.concatenate([[graph.start], order[order != graph.start]])
        done = min(n, batch)
        seeds = order[:done]
        d = graph.square[seeds] - 2 * graph.x[seeds] @ graph.x[seeds].T
        ids = np.argsort(d, axis=1)[:, : 2 * beam]
        graph._connect(seeds, seeds[ids], np.take_along_axis(d, ids, axis=1))
        while done < n:
            points = order[done : done + min(done, batch)]
            graph._connect(points, *graph.search(graph.x[points], beam))
            done += len(points)
        return graph

    def beam_for(self, queries: np.ndarray, k: int, beam: int, recall: float) -> int:
        """The beam, doubled from ``beam`` on, at which searches find enough of the ``k`` nearest of some queries.

        What they should find is known from all their inner products. A beam as wide as the graph is the last one tried.
        """
        n = len(self.x)
        k = min(k, n)
        best = np.argpartition(-(queries @ self.x.T), k - 1, axis=1)[:, :k]
        while beam < n:
            found, _ = self.search(queries, beam)
            hits = (best[:, :, None] == found[:, None, :k]).any(axis=2).sum()
            if hits >= recall * best.size:
                break
            beam *= 2
        return min(beam, n)

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest points found for each query, nearest first; -1 where there are fewer.

        In each step the ``wide`` nearest points that are not expanded yet hand in
        their neighbours; a search ends when all points of its beam are expanded.
        """
        b, n = len(queries), len(self.x)
        wide = max(4, beam // 32)
        seen = np.zeros((b, n + 1), dtype=bool)
        seen[:, n] = True  # where an edge list has ended
        ids = np.full((b, beam), -1, dtype=np.int64)
        d = np.full((b, beam), np.inf, dtype=np.float32)
        expanded = np.zeros((b, beam), dtype=bool)
        ids[:, 0], seen[:, self.start] = self.start, True
        d[:, 0] = self.square[self.start] - 2 * queries @ self.x[self.start]
        active = np.arange(b)
        while len(active):
            q = queries[active]
            fresh_ids, fresh_d = [ids[active]], [d[active]]
            flags = [expanded[active]]
            waiting = np.where(flags[0] | (fresh_ids[0] < 0), np.inf, fresh_d[0])
            pick = np.argsort(waiting, axis=1, kind="stable")[:, :wide]
            usable = np.take_along_axis(waiting, pick, axis=1) < np.inf
            rows = np.arange(len(active))
            for k in range(pick.shape[1]):
                node = np.where(usable[:, k], fresh_ids[0][rows, pick[:, k]], -1)
                flags[0][rows[usable[:, k]], pick[usable[:, k], k]] = True
                near = self.edges[node]
                near = np.where((near < 0) | (node < 0)[:, None], n, near)
                new = ~seen[active[:, None], near]
                seen[active[:, None], near] = True
                near = np.where(new, near, -1)
                dot = np.matmul(self.x[near], q[:, :, None])[:, :, 0]
                fresh_ids.append(near)
                fresh_d.append(np.where(new, self.square[near] - 2 * dot, np.inf).astype(np.float32))
                flags.append(np.zeros(near.shape, dtype=bool))
            all_ids, all_d, all_flags = np.hstack(fresh_ids), np.hstack(fresh_d), np.hstack(flags)
            best = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
            ids[active] = np.take_along_axis(all_ids, best, axis=1)
            d[active] = np.take_along_axis(all_d, best, axis=1)
            expanded[active] = np.take_along_axis(all_flags, best, axis=1)
            open_ = (~expanded[active] & (d[active] < np.inf)).any(axis=1)
            active = active[open_]
        best = np.argsort(d, axis=1, kind="stable")
        ids, d = np.take_along_axis(ids, best, 1), np.take_along_axis(d, best, 1)
        return np.where(np.isinf(d), -1, ids), d

    def _connect(self, points: np.ndarray, ids: np.ndarray, d: np.ndarray) -> None:
        """Give points their pruned candidates as edges, and the chosen ones an edge back."""
        ids = np.where(ids == points[:, None], -1, ids)
        self.edges[points] = self._pruned(points, ids, d)
        source = np.repeat(points, self.degree)
        target = self.edges[points].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, first, number = np.unique(target, return_index=True, return_counts=True)
        for k in range(0, len(nodes), 512):
            some, width = nodes[k : k + 512], number[k : k + 512].max()
            at = first[k : k + 512, None] + np.arange(width)
            back = np.where(np.arange(width) < number[k : k + 512, None], source[np.minimum(at, len(source) - 1)], -1)
            own = self.edges[some]
            back = np.where((back[:, :, None] == own[:, None, :]).any(axis=2), -1, back)
            both = np.hstack([own, back])
            dist = self.square[both] - 2 * np.matmul(self.x[both], self.x[some][:, :, None])[:, :, 0]
            rank = np.argsort(np.where(both < 0, np.inf, dist), axis=1, kind="stable")
            both, dist = np.take_along_axis(both, rank, 1), np.take_along_axis(dist, rank, 1)
            fits = (both >= 0).sum(axis=1) <= self.degree
            if fits.any():
                self.edges[some[fits], : min(self.degree, both.shape[1])] = both[fits, : self.degree]
            if not fits.all():
                self.edges[some[~fits]] = self._pruned(some[~fits], both[~fits], dist[~fits])

    def _pruned(self, points: np.ndarray, ids: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Robust pruning: the nearest candidate becomes an edge and takes out those it is ``alpha`` times nearer to."""
        out = np.full((len(points), self.degree), -1, dtype=np.int32)
        for k in range(0, len(points), 128):
            c, p = ids[k : k + 128], points[k : k + 128]
            own = np.maximum(d[k : k + 128] + self.square[p][:, None], 0)  # squared distances to the point
            vectors = self.x[c]
            between = self.square[c][:, :, None] + self.square[c][:, None, :] - 2 * np.matmul(vectors, vectors.transpose(0, 2, 1))
            alive = c >= 0
            rows = np.arange(len(c))
            for slot in range(self.degree):
                pick = np.where(alive, own, np.inf).argmin(axis=1)
                left = alive[rows, pick]
                if not left.any():
                    break
                out[k + rows[left], slot] = c[rows[left], pick[left]]
                alive[rows, pick] = False
                alive &= ~((self.alpha**2 * between[rows, pick] <= own) & left[:, None])
        return out
