"""Similarity join of ordered sets in a prefix tree.

Sets are sorted by one global order and share the nodes of their common beginnings. Similar sets
share one of their first elements, as many as may be missing in the other and one more; only the
branches of sets that do are entered, so an order with rare elements first leaves few. A query walks
them once: what it has in common with a shared beginning is counted once for all sets below,
and a branch is left as soon as the elements that remain, on either side, cannot bring the overlap
to the threshold. A branch whose sets are all connected with the query already is left as well, so
the links found are enough for connected components, and a group of near copies costs little more
than its size.
"""

from __future__ import annotations

import numpy as np

CHUNK = 64  # elements of a node that are counted at a time


class _Node:
    __slots__ = ("run", "kids", "low", "high", "end", "some", "mixed")

    def __init__(self, run: np.ndarray, size: int, owner: int):
        self.run, self.kids, self.low, self.high = run, {}, size, size
        self.end, self.some, self.mixed = -1, owner, False


class PrefixTree:
    def __init__(self, percent: int):
        self.percent = percent
        self.root: _Node | None = None
        self.parent: list[int] = []
        self.branches: dict[int, list[int]] = {}  # of a first element: first elements of the sets that have it

    def _first(self, elements: np.ndarray) -> list[int]:
        """Of these elements a set shares at least one with every similar set, whose own first ones have it."""
        n = len(elements)
        least = -(-self.percent * n // 100)  # elements that a similar set has too
        return elements[: n - least + 1].tolist()

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def add(self, elements: np.ndarray) -> list[int]:
        """Inserts a non-empty set; the earlier sets it was linked with, one for each component."""
        me = len(self.parent)
        self.parent.append(me)
        found = self._similar(elements, me) if self.root else []
        self._insert(elements, me)
        key = int(elements[0])
        for e in self._first(elements):
            self.branches.setdefault(e, []).append(key)
        return found

    def _similar(self, x: np.ndarray, me: int) -> list[int]:
        n, t, found = len(x), self.percent, []
        keys = set().union(*[self.branches[e] for e in self._first(x) if e in self.branches])
        stack = [(self.root.kids[k], 0, 0) for k in keys]
        while stack:
            if not self.root.mixed and self.find(self.root.some) == self.find(me):
                break
            node, overlap, depth = stack.pop()
            if not node.mixed and self.find(node.some) == self.find(me):
                continue
            if 100 * node.high < t * n or t * node.low > 100 * n:
                continue
            need = -(-t * (n + node.low) // (100 + t))
            run, hopeless = node.run, False
            for i in range(0, len(run), CHUNK):
                part = run[i:i + CHUNK]
                at = x.searchsorted(part)
                at[at == n] = n - 1
                overlap += int(np.count_nonzero(x[at] == part))
                depth += len(part)
                left = n - int(x.searchsorted(part[-1], "right"))
                if overlap + min(left, node.high - depth) < need:
                    hopeless = True
                    break
            if hopeless:
                continue
            if node.end >= 0 and 100 * overlap >= t * (n + depth - overlap) and self.find(node.end) != self.find(me):
                found.append(node.end)
                self.parent[self.find(me)] = self.find(node.end)
            if node.kids:
                own = x[np.searchsorted(x, run[-1], "right"):][:1] if depth else x[:1]
                first = node.kids.get(int(own[0])) if len(own) else None
                stack.extend((kid, overlap, depth) for kid in node.kids.values() if kid is not first)
                if first:
                    stack.append((first, overlap, depth))
        return found

    def _insert(self, x: np.ndarray, me: int) -> None:
        n, at = len(x), 0
        if self.root is None:
            self.root = _Node(x[:0], n, me)
        node = self.root
        while True:
            node.low, node.high = min(node.low, n), max(node.high, n)
            if not node.mixed and self.find(node.some) != self.find(me):
                node.mixed = True
            if at == n:
                if node.end < 0:
                    node.end = me
                return
            kid = node.kids.get(int(x[at]))
            if kid is None:
                leaf = _Node(x[at:], n, me)
                leaf.end = me
                node.kids[int(x[at])] = leaf
                return
            m = min(len(kid.run), n - at)
            differ = np.flatnonzero(kid.run[:m] != x[at:at + m])
            same = int(differ[0]) if len(differ) else m
            if same < len(kid.run):  # the run divides
                upper = _Node(kid.run[:same], kid.low, kid.some)
                upper.high, upper.mixed = kid.high, kid.mixed
                kid.run = kid.run[same:]
                upper.kids[int(kid.run[0])] = kid
                node.kids[int(x[at])] = upper
                kid = upper
            node, at = kid, at + same
