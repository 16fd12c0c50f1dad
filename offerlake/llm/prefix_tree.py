"""A prefix tree of ordered sets, for Jaccard links with pruning.

Sets are sorted lists of ranks.  The tree is path-compressed: a node holds the
stretch of ranks that all sets below it share after their common beginning.
A probe walks down from the root and carries its overlap with the path, which
counts for every set below; it leaves a subtree once the overlap so far plus
what can still come, by the lengths that remain on both sides, is too small.
"""

from __future__ import annotations

from bisect import bisect_right


def need(a: int, b: int, percent: int) -> int:
    """Smallest intersection with 100 * i >= percent * (a + b - i)."""
    return -(-percent * (a + b) // (100 + percent))


class Node:
    __slots__ = ("start", "end", "of", "children", "set", "alive", "short", "long", "parent")

    def __init__(self, start: int, end: int, of: int, parent: Node | None):
        self.start, self.end, self.of, self.parent = start, end, of, parent
        self.children: list[Node] = []
        self.set: int | None = None
        self.alive, self.short, self.long = 0, 0, 0


class PrefixTree:
    #: A long stretch is compared in pieces, so that a probe can leave early.
    PIECE = 64

    def __init__(self, sets: list[list[int]], percent: int):
        """``sets``: distinct, non-empty, ascending."""
        self.sets, self.percent = sets, percent
        self.leaf: dict[int, Node] = {}
        order = sorted(range(len(sets)), key=sets.__getitem__)
        self.root = Node(0, 0, order[0] if order else 0, None)
        path, last = [self.root], []
        for k in order:
            s = sets[k]
            same = shared(last, s)
            while path[-1].start >= same and path[-1] is not self.root:
                path.pop()
            top = path[-1]
            if top.end > same:  # split the stretch where the sets part
                lower = Node(same, top.end, top.of, top)
                lower.children, lower.set = top.children, top.set
                for c in lower.children:
                    c.parent = lower
                if lower.set is not None:
                    self.leaf[lower.set] = lower
                top.end, top.children, top.set = same, [lower], None
            if len(s) > same:
                node = Node(same, len(s), k, top)
                top.children.append(node)
                path.append(node)
            else:
                node = top
            node.set = k
            self.leaf[k] = node
            last = s
        self._measure()

    def _measure(self) -> None:
        stack, seen = [self.root], []
        while stack:
            n = stack.pop()
            seen.append(n)
            stack.extend(n.children)
        for n in reversed(seen):
            n.alive = (n.set is not None) + sum(c.alive for c in n.children)
            lengths = [c.short for c in n.children] + ([n.end] if n.set is not None else [])
            n.short = min(lengths, default=0)
            n.long = max([c.long for c in n.children] + ([n.end] if n.set is not None else []), default=0)

    def remove(self, k: int) -> None:
        n = self.leaf[k]
        while n is not None:
            n.alive -= 1
            n = n.parent
        self.leaf[k].set = None

    def linked(self, x: list[int]) -> list[int]:
        """Sets still in the tree that link with the set ``x``."""
        out, members, size, p = [], frozenset(x), len(x), self.percent
        stack = [(self.root, 0)]
        while stack:
            node, overlap = stack.pop()
            if not node.alive or 100 * node.long < p * size or 100 * size < p * node.short:
                continue
            least = need(size, max(node.short, -(-p * size // 100)), p)
            ranks, at = self.sets[node.of], node.start
            while at < node.end:
                to = min(at + self.PIECE, node.end)
                overlap += len(members.intersection(ranks[at:to]))
                at = to
                rest = min(node.long - at, size - bisect_right(x, ranks[at - 1]))
                if overlap + rest < least:
                    break
            else:
                if node.set is not None and overlap >= need(size, node.end, p):
                    out.append(node.set)
                stack.extend((c, overlap) for c in node.children)
        return out


def shared(a: list[int], b: list[int]) -> int:
    """Length of the common beginning, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


def forest(sets: list[list[int]], percent: int) -> list[tuple[int, int]]:
    """Links that connect what is connected: one fewer than sets in each component.

    A set leaves the tree when it is reached, so a dense group costs one walk
    over its tree and not one for each pair.
    """
    tree = PrefixTree(sets, percent)
    edges: list[tuple[int, int]] = []
    for first in range(len(sets)):
        if tree.leaf[first].set != first:
            continue
        tree.remove(first)
        reached = [first]
        while reached:
            k = reached.pop()
            for other in tree.linked(sets[k]):
                tree.remove(other)
                edges.append((k, other))
                reached.append(other)
    return edges
