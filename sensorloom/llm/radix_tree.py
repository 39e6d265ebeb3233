"""An adaptive radix tree over byte strings: nodes grow through layouts for 4, 16, 48 and 256
children, and bytes that nothing branches off are kept as one compressed path."""

from __future__ import annotations

from bisect import bisect_left


class Sorted:
    """Up to 4, then up to 16 children: their bytes in order, and the children beside them."""

    __slots__ = ("bytes", "nodes", "capacity")

    def __init__(self, capacity: int = 4):
        self.bytes, self.nodes, self.capacity = bytearray(), [], capacity

    def find(self, byte: int) -> Node | None:
        at = self.bytes.find(byte)
        return self.nodes[at] if at >= 0 else None

    def put(self, byte: int, node: Node) -> Sorted | Indexed:
        """Add a child, or put another one in its place; gives the layout to go on with."""
        at = bisect_left(self.bytes, byte)
        if at < len(self.bytes) and self.bytes[at] == byte:
            self.nodes[at] = node
            return self
        if len(self.nodes) == self.capacity:
            if self.capacity == 16:
                return Indexed(self).put(byte, node)
            self.capacity = 16
        self.bytes.insert(at, byte)
        self.nodes.insert(at, node)
        return self

    def __iter__(self):
        return iter(self.nodes)


class Indexed:
    """Up to 48 children: a table of 256 places into their list."""

    __slots__ = ("places", "nodes")

    def __init__(self, smaller: Sorted):
        self.places, self.nodes = bytearray(256), list(smaller.nodes)
        for place, byte in enumerate(smaller.bytes, 1):
            self.places[byte] = place

    def find(self, byte: int) -> Node | None:
        place = self.places[byte]
        return self.nodes[place - 1] if place else None

    def put(self, byte: int, node: Node) -> Indexed | Direct:
        place = self.places[byte]
        if place:
            self.nodes[place - 1] = node
        elif len(self.nodes) == 48:
            return Direct(self).put(byte, node)
        else:
            self.nodes.append(node)
            self.places[byte] = len(self.nodes)
        return self

    def __iter__(self):
        return (self.nodes[place - 1] for place in self.places if place)


class Direct:
    """Up to 256 children: one place for each byte."""

    __slots__ = ("nodes",)

    def __init__(self, smaller: Indexed):
        self.nodes = [smaller.find(byte) for byte in range(256)]

    def find(self, byte: int) -> Node | None:
        return self.nodes[byte]

    def put(self, byte: int, node: Node) -> Direct:
        self.nodes[byte] = node
        return self

    def __iter__(self):
        return (node for node in self.nodes if node is not None)


class Node:
    """``path``: the bytes from the parent to here. ``ends``: rows whose key ends here.
    ``row``: one of the rows whose key leads through here."""

    __slots__ = ("path", "kids", "ends", "row")

    def __init__(self, path: bytes, row: int):
        self.path, self.row, self.kids, self.ends = path, row, None, []

    def put(self, node: Node) -> None:
        self.kids = (self.kids or Sorted()).put(node.path[0], node)


def common(a: bytes, b: bytes) -> int:
    """Number of bytes that both begin with."""
    n = min(len(a), len(b))
    differing = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differing.bit_length() + 7) // 8


class RadixTree:
    def __init__(self):
        self.root: Node | None = None

    def insert(self, key: bytes, row: int) -> None:
        if self.root is None:
            self.root = Node(b"", row)
        node, at = self.root, 0
        while at < len(key):
            kid = node.kids.find(key[at]) if node.kids else None
            if kid is None:
                leaf = Node(key[at:], row)
                leaf.ends.append(row)
                node.put(leaf)
                return
            path = kid.path
            if not key.startswith(path, at):
                shared = common(path, key[at : at + len(path)])
                inner = Node(path[:shared], kid.row)
                kid.path = path[shared:]
                inner.put(kid)
                node.put(inner)
                kid = inner
            node, at = kid, at + len(kid.path)
        node.ends.append(row)

    def preorder(self) -> list[tuple[Node, int, int]]:
        """(node, place of its parent in this list, bytes above its path)."""
        found, todo = [], [(self.root, -1, 0)] if self.root else []
        while todo:
            node, parent, above = todo.pop()
            found.append((node, parent, above))
            if node.kids:
                below = above + len(node.path)
                todo += [(kid, len(found) - 1, below) for kid in node.kids]
        return found
