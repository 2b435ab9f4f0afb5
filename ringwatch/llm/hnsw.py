"""A hierarchical navigable small-world graph over the unit vectors of one shard.

Nodes are inserted one by one on random levels; each is linked to near nodes that are
not nearer to one another (so that links lead out of dense groups). A search walks
down the levels, then widens a beam on the lowest; it goes on as long as it meets nodes
within the radius that is asked for, however many they are.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Sequence

import numpy as np
import xxhash

#: Links of a node on the upper levels; twice as many on the lowest.
LINKS = 12
#: Beam while nodes are inserted.
BUILD_BEAM = 40


class Hnsw:
    """The graph. ``vectors`` are unit vectors in rows; ``keys`` settle the levels, the same on every run."""

    def __init__(self, vectors: np.ndarray, keys: Sequence[int], links: int = LINKS, beam: int = BUILD_BEAM):
        n = len(vectors)
        self.vectors = np.ascontiguousarray(vectors, dtype=np.float32)
        self.links = links
        draws = [(xxhash.xxh64_intdigest(str(k).encode()) + 1) / 2.0**64 for k in keys]
        self.level = np.array([int(-np.log(u) / np.log(links)) for u in draws], dtype=np.int32)
        tops = int(self.level.max()) + 1 if n else 1
        width = [2 * links, *[links] * (tops - 1)]
        self.near = [np.full((n, w), -1, dtype=np.int32) for w in width]
        self.degree = [np.zeros(n, dtype=np.int32) for _ in width]
        self._prepare()
        self.entry = 0
        for node in range(1, n):
            self._insert(node, beam)

    def _prepare(self) -> None:
        self._stamp = np.zeros(len(self.vectors), dtype=np.int64)
        self._now = 0

    def _neighbours(self, level: int, node: int) -> np.ndarray:
        return self.near[level][node, : self.degree[level][node]]

    def _greedy(self, query: np.ndarray, node: int, level: int) -> int:
        best = float(self.vectors[node] @ query)
        while True:
            around = self._neighbours(level, node)
            if not len(around):
                return node
            similar = self.vectors[around] @ query
            at = int(similar.argmax())
            if similar[at] <= best:
                return node
            best, node = float(similar[at]), int(around[at])

    def _beam(self, query: np.ndarray, entry: int, level: int, beam: int, radius: float | None = None):
        """The ``beam`` nearest nodes met as (similarity, node), and all met within ``radius``."""
        self._now += 1
        stamp, now, vectors = self._stamp, self._now, self.vectors
        stamp[entry] = now
        first = float(vectors[entry] @ query)
        waiting, best, within = [(-first, entry)], [(first, entry)], []
        if radius is None:
            radius = 2.0
        if first >= radius:
            within.append(entry)
        while waiting:
            similar, node = heapq.heappop(waiting)
            if len(best) >= beam and -similar < best[0][0] and -similar < radius:
                break
            around = self._neighbours(level, node)
            around = around[stamp[around] != now]
            if not len(around):
                continue
            stamp[around] = now
            for s, other in zip((vectors[around] @ query).tolist(), around.tolist()):
                if s >= radius:
                    within.append(other)
                    heapq.heappush(waiting, (-s, other))
                elif len(best) < beam or s > best[0][0]:
                    heapq.heappush(waiting, (-s, other))
                else:
                    continue
                if len(best) < beam:
                    heapq.heappush(best, (s, other))
                elif s > best[0][0]:
                    heapq.heapreplace(best, (s, other))
        return best, within

    def _spread(self, found: list[tuple[float, int]], most: int) -> list[int]:
        """Up to ``most`` nodes, nearest first, none nearer to a chosen one than to the node itself."""
        ordered = sorted(found, key=lambda x: (-x[0], x[1]))
        if len(ordered) <= 1:
            return [node for _, node in ordered]
        nodes = np.array([node for _, node in ordered])
        among = self.vectors[nodes] @ self.vectors[nodes].T
        chosen: list[int] = []
        closest = np.full(len(nodes), -2.0)
        for k, (similar, _) in enumerate(ordered):
            if closest[k] < similar:
                chosen.append(k)
                if len(chosen) == most:
                    break
                np.maximum(closest, among[k], out=closest)
        left = set(chosen)
        for k in range(len(ordered)):  # places that are left go to the nearest of the others
            if len(chosen) == most:
                break
            if k not in left:
                chosen.append(k)
        return [int(nodes[k]) for k in chosen]

    def _insert(self, node: int, beam: int) -> None:
        query, top = self.vectors[node], int(self.level[self.entry])
        at = self.entry
        for level in range(top, int(self.level[node]), -1):
            at = self._greedy(query, at, level)
        for level in range(min(top, int(self.level[node])), -1, -1):
            found, _ = self._beam(query, at, level, beam)
            at = max(found)[1]
            for other in self._spread(found, self.links):
                self._link(level, node, other)
                self._link(level, other, node)
        if self.level[node] > top:
            self.entry = node

    def _link(self, level: int, node: int, other: int) -> None:
        near, degree = self.near[level], self.degree[level]
        if degree[node] < near.shape[1]:
            near[node, degree[node]] = other
            degree[node] += 1
            return
        around = np.append(near[node], np.int32(other))
        similar = (self.vectors[around] @ self.vectors[node]).tolist()
        kept = self._spread(list(zip(similar, around.tolist())), near.shape[1])
        near[node, : len(kept)] = kept
        degree[node] = len(kept)

    def within(self, query: np.ndarray, radius: float, beam: int) -> list[int]:
        """Nodes with a similarity of ``radius`` or more that a search with this beam meets."""
        if not len(self.vectors):
            return []
        at = self.entry
        for level in range(int(self.level[at]), 0, -1):
            at = self._greedy(query, at, level)
        return self._beam(query, at, 0, beam, radius)[1]

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        arrays = {f"near{k}": a for k, a in enumerate(self.near)} | {f"degree{k}": a for k, a in enumerate(self.degree)}
        np.savez(out, vectors=self.vectors, level=self.level, entry=self.entry, links=self.links, **arrays)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Hnsw:
        graph = cls.__new__(cls)
        with np.load(io.BytesIO(data)) as stored:
            graph.vectors, graph.level = stored["vectors"], stored["level"]
            graph.entry, graph.links = int(stored["entry"]), int(stored["links"])
            levels = sum(name.startswith("near") for name in stored.files)
            graph.near = [stored[f"near{k}"] for k in range(levels)]
            graph.degree = [stored[f"degree{k}"] for k in range(levels)]
        graph._prepare()
        return graph
