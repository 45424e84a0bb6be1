"""An adaptive radix tree over byte keys, with four node layouts and path compression.

Nodes hold up to 4 or 16 children as a sorted byte list, up to 48 behind a 256-byte index, or up to
256 directly; a node that is full takes the next layout. Bytes on which no key parts are kept in the
node below them. Keys may be prefixes of one another: any node can carry a value.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

SMALL, INDEXED, DIRECT = (4, 16), 48, 256


class Node:
    __slots__ = ("prefix", "value", "room", "edges", "kids")

    def __init__(self, prefix: bytes, value=None):
        self.prefix, self.value = prefix, value
        self.room = SMALL[0]
        self.edges = bytearray()  # sorted bytes, or the index of an indexed node
        self.kids: list = []

    def child(self, byte: int) -> Node | None:
        if self.room == DIRECT:
            return self.kids[byte]
        if self.room == INDEXED:
            slot = self.edges[byte]
            return self.kids[slot - 1] if slot else None
        at = bisect_left(self.edges, byte)
        return self.kids[at] if at < len(self.edges) and self.edges[at] == byte else None

    def put(self, byte: int, node: Node) -> None:
        """Add a child, or replace the one on that byte."""
        if self.room == DIRECT:
            self.kids[byte] = node
        elif self.room == INDEXED:
            slot = self.edges[byte]
            if slot:
                self.kids[slot - 1] = node
            elif len(self.kids) < INDEXED:
                self.kids.append(node)
                self.edges[byte] = len(self.kids)
            else:
                self._grow()
                self.put(byte, node)
        else:
            at = bisect_left(self.edges, byte)
            if at < len(self.edges) and self.edges[at] == byte:
                self.kids[at] = node
            elif len(self.kids) < self.room:
                self.edges.insert(at, byte)
                self.kids.insert(at, node)
            else:
                self._grow()
                self.put(byte, node)

    def _grow(self) -> None:
        below = list(self.children())
        if self.room == SMALL[0]:
            self.room = SMALL[1]
        elif self.room == SMALL[1]:
            self.room, self.edges = INDEXED, bytearray(256)
            for slot, (byte, _) in enumerate(below, 1):
                self.edges[byte] = slot
        else:
            self.room, self.edges, self.kids = DIRECT, bytearray(), [None] * 256
            for byte, node in below:
                self.kids[byte] = node

    def children(self) -> Iterator[tuple[int, Node]]:
        """Bytes and children in the order of the bytes."""
        if self.room == DIRECT:
            yield from ((b, n) for b, n in enumerate(self.kids) if n is not None)
        elif self.room == INDEXED:
            yield from ((b, self.kids[s - 1]) for b, s in enumerate(self.edges) if s)
        else:
            yield from zip(self.edges, self.kids, strict=True)


class RadixTree:
    def __init__(self):
        self.root = Node(b"")

    def insert(self, key: bytes, value) -> None:
        """Set the value of a key; only the bytes after the last fork are stored anew."""
        node, at = self.root, 0
        while True:
            byte = key[at:at + 1]
            if not byte:
                node.value = value
                return
            below = node.child(byte[0])
            if below is None:
                node.put(byte[0], Node(key[at + 1:], value))
                return
            at += 1
            shared = _shared(below.prefix, key, at)
            if shared < len(below.prefix):
                fork = Node(below.prefix[:shared])
                fork.put(below.prefix[shared], below)
                below.prefix = below.prefix[shared + 1:]
                node.put(byte[0], fork)
                below = fork
            node, at = below, at + shared

    def walk(self) -> Iterator[tuple[Node, int, bytes, int]]:
        """Every node above its children: the node, its parent's number (-1 for the root), the bytes
        from the parent to it, and its own number. Numbers follow the order of the walk."""
        stack, count = [(self.root, -1, b"")], 0
        while stack:
            node, parent, way = stack.pop()
            yield node, parent, way, count
            stack += [(n, count, bytes([b]) + n.prefix) for b, n in reversed(list(node.children()))]
            count += 1


def _shared(prefix: bytes, key: bytes, at: int) -> int:
    """Length of the common start of `prefix` and `key[at:]`."""
    if key.startswith(prefix, at):
        return len(prefix)
    low, high = 0, len(prefix)
    while low < high:
        middle = (low + high + 1) // 2
        if key.startswith(prefix[:middle], at):
            low = middle
        else:
            high = middle - 1
    return low
