"""BK-tree over 64-bit fingerprints: a child hangs under its parent's integer Hamming distance."""

from __future__ import annotations

from collections.abc import Iterable


class BKTree:
    """Distinct fingerprints; equal ones are one node, so ties need no rule."""

    def __init__(self, fingerprints: Iterable[int] = ()):
        self.nodes: list[tuple[int, dict[int, int]]] = []
        for fp in fingerprints:
            self.add(fp)

    def add(self, fp: int) -> None:
        if not self.nodes:
            self.nodes.append((fp, {}))
            return
        at = 0
        while True:
            other, children = self.nodes[at]
            distance = (fp ^ other).bit_count()
            if not distance:
                return
            if distance not in children:
                children[distance] = len(self.nodes)
                self.nodes.append((fp, {}))
                return
            at = children[distance]

    def within(self, fp: int, radius: int) -> list[int]:
        """Stored fingerprints at `radius` or less; only edges inside [distance - radius, distance + radius] are followed."""
        found, open_nodes = [], [0] if self.nodes else []
        while open_nodes:
            other, children = self.nodes[open_nodes.pop()]
            distance = (fp ^ other).bit_count()
            if distance <= radius:
                found.append(other)
            if children:
                low, high = distance - radius, distance + radius
                open_nodes.extend(child for edge, child in children.items() if low <= edge <= high)
        return found
