"""Links between near fingerprints of one block, found in a hierarchy over their Gray order.

Leaves are fingerprints in the order of their Gray rank, in which neighbours differ in few bits. Sixteen
neighbours form a node, sixteen nodes an upper one, up to one root for each block. A node keeps the bits
in which all its leaves agree, and only those that its parent does not have yet. Descending with a
query, differences in these bits add up; a whole group is left as soon as the sum exceeds the radius.
At a leaf every bit has been counted once, so the sum is the distance.

Only connected groups matter, so a node is also left if all its leaves are known to be connected with the
query. Thousands of near copies are thus joined without a look at all their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

FANOUT = 16
#: Candidate pairs that are held at once.
FRONTIER = 1 << 20
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


class _Level:
    """Nodes of one level: bits kept here (``mask``), their values, and where the children begin."""

    def __init__(self, both: np.ndarray, either: np.ndarray, child: np.ndarray, last: np.ndarray) -> None:
        self.agree = ~(both ^ either)
        self.pattern = both & self.agree
        self.both, self.either = both, either
        self.child = child  # first child of each node, with the end
        self.last = last  # last leaf of each node
        self.mask = self.agree


def _levels(prints: np.ndarray, starts: np.ndarray) -> list[_Level]:
    """From the leaves up to one root for each of the blocks that begin at ``starts``."""
    n = len(prints)
    leaf = np.arange(n + 1)
    levels = [_Level(prints, prints, leaf, leaf[:-1])]
    while len(starts) < n:
        block = np.searchsorted(starts, np.arange(n), side="right") - 1
        first = np.flatnonzero((np.arange(n) - starts[block]) % FANOUT == 0)
        below = levels[-1]
        child = np.append(first, n)
        levels.append(
            _Level(
                np.bitwise_and.reduceat(below.both, first),
                np.bitwise_or.reduceat(below.either, first),
                child,
                below.last[child[1:] - 1],
            )
        )
        below.mask = below.agree & ~np.repeat(levels[-1].agree, np.diff(child))
        starts = np.searchsorted(first, starts)
        n = len(first)
    return levels


def _uniform(levels: list[_Level], label: np.ndarray) -> list[np.ndarray]:
    """For each level, the component of a node whose leaves are all connected, else -1."""
    out = [label]
    for level in levels[1:]:
        first = level.child[:-1]
        low = np.minimum.reduceat(out[-1], first)
        out.append(np.where(low == np.maximum.reduceat(out[-1], first), low, -1))
    return out


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (the least leaf of each component) after connecting ``a`` with ``b``."""
    while len(a):
        one, other = label[a], label[b]
        low, high = np.minimum(one, other), np.maximum(one, other)
        apart = low != high
        if not apart.any():
            break
        a, b = a[apart], b[apart]
        np.minimum.at(label, high[apart], low[apart])
        while True:
            root = label[label]
            if np.array_equal(root, label):
                break
            label = root
    return label


def _search(levels: list[_Level], uniform: list[np.ndarray], queries: np.ndarray, roots: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links (query, later leaf) within the radius between components that are not yet connected."""
    prints, label = levels[0].pattern, uniform[0]
    top = levels[-1]
    differ = np.bitwise_count((prints[queries] ^ top.pattern[roots]) & top.mask[roots]).astype(np.uint8)
    stack = [(len(levels) - 1, queries, roots, differ)]
    while stack:
        depth, query, node, differ = stack.pop()
        open_ = (differ <= radius) & (levels[depth].last[node] > query) & (uniform[depth][node] != label[query])
        query, node, differ = query[open_], node[open_], differ[open_]
        if not len(query):
            continue
        if depth == 0:
            yield query, node
            continue
        if len(query) > FRONTIER // FANOUT and len(query) > 1:
            for half in np.array_split(np.arange(len(query)), 2):
                stack.append((depth, query[half], node[half], differ[half]))
            continue
        level, below = levels[depth], levels[depth - 1]
        width = level.child[node + 1] - level.child[node]
        query, differ = np.repeat(query, width), np.repeat(differ, width)
        ends = np.cumsum(width)
        node = np.arange(ends[-1]) + np.repeat(level.child[node] - (ends - width), width)
        more = np.bitwise_count((prints[query] ^ below.pattern[node]) & below.mask[node])
        stack.append((depth - 1, query, node, differ + more))


def spanning_links(prints: np.ndarray, starts: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is connected within ``radius`` in each block: (leaf, least leaf).

    ``prints`` are distinct within a block and in Gray order there; blocks begin at ``starts``. Queries
    run in growing batches, and what they connect narrows the search of the next ones.
    """
    n = len(prints)
    levels = _levels(prints, starts)
    block = np.searchsorted(starts, np.arange(n), side="right") - 1
    label = np.arange(n)
    near = np.flatnonzero(
        (np.bitwise_count(prints[1:] ^ prints[:-1]) <= radius) & (block[1:] == block[:-1])
    )
    label = _join(label, near, near + 1)
    size = np.diff(np.append(starts, n))[block]
    done, batch = 0, 256
    while done < n:
        stop = min(n, done + batch)
        uniform = _uniform(levels, label)
        queries = np.arange(done, stop)
        queries = queries[size[queries] > 1]
        for query, leaf in _search(levels, uniform, queries, block[queries], radius):
            label = _join(label, query, leaf)
        done, batch = stop, min(batch * 4, 1 << 16)
    moved = np.flatnonzero(label != np.arange(n))
    return moved, label[moved]
