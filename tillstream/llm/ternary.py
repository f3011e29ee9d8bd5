"""A ternary search tree over sequences of whole numbers."""

from __future__ import annotations

from collections.abc import Iterator

NONE = -1


def medians(count: int) -> Iterator[int]:
    """All indexes below `count`, the middle of every range before its halves."""
    ranges = [(0, count)]
    while ranges:
        low, high = ranges.pop()
        if low < high:
            middle = (low + high) // 2
            yield middle
            ranges += [(low, middle), (middle + 1, high)]


class TernaryTree:
    """Nodes by number: label, the node for the next place, and those for smaller and larger labels.

    `parent` is the node of the place before (NONE at the first place); it has a smaller number.
    """

    def __init__(self):
        self.label: list[int] = []
        self.less: list[int] = []
        self.more: list[int] = []
        self.next: list[int] = []
        self.parent: list[int] = []
        self.first = NONE

    def _node(self, label: int, parent: int) -> int:
        for links in (self.less, self.more, self.next):
            links.append(NONE)
        self.label.append(label)
        self.parent.append(parent)
        return len(self.label) - 1

    def path(self, sequence: list[int]) -> list[int]:
        """The nodes of a sequence, place by place; missing ones are made."""
        nodes, parent = [], NONE
        for label in sequence:
            links, at = (self.next, parent) if parent != NONE else (None, NONE)
            node = links[at] if links is not None else self.first
            while node != NONE and self.label[node] != label:
                links, at = (self.less if label < self.label[node] else self.more), node
                node = links[at]
            if node == NONE:
                node = self._node(label, parent)
                if links is None:
                    self.first = node
                else:
                    links[at] = node
            nodes.append(node)
            parent = node
        return nodes

    def height(self) -> int:
        """Most comparisons at one place."""
        best, open_ = 0, [(self.first, 1)]
        while open_:
            node, steps = open_.pop()
            if node != NONE:
                best = max(best, steps)
                open_ += [(self.less[node], steps + 1), (self.more[node], steps + 1),
                          (self.next[node], 1)]
        return best
