"""Deep-shallow string sorting, with the common prefix of each two neighbours.

Shallow: multikey quicksort on 8-byte digits. A part whose strings agree up to a digit
is split in three by a pivot, the median of three of its strings: what is less and what
is greater is split again by the same digit, what is equal goes on to the next. All
parts are split at once, breadth first. Deep: what shares the whole shallow prefix is
ordered by a blind trie, which compares each string in full with one other string only.
"""

from __future__ import annotations

import numpy as np

DIGIT = 8


def common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


class _Blind:
    """A blind trie: inner nodes know the place of a branching byte, not what stands before it."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root: list | int | None = None  # inner node: [place, {byte: node}]; byte -1 for a string that ends there

    def add(self, i: int) -> None:
        s = self.strings[i]
        if self.root is None:
            self.root = [i]
            return
        node = self.root
        while isinstance(node, tuple):
            place, below = node
            c = s[place] if place < len(s) else -1
            node = below[c] if c in below else next(iter(below.values()))
        other = self.strings[node[0]]
        if other == s:
            node.append(i)
            return
        at = common(s, other)
        mine, theirs = (x[at] if at < len(x) else -1 for x in (s, other))
        above, key, node = None, None, self.root
        while isinstance(node, tuple) and node[0] < at:
            above, key = node, s[node[0]] if node[0] < len(s) else -1
            node = node[1][key]
        if isinstance(node, tuple) and node[0] == at:
            node[1][mine] = [i]
            return
        fork = (at, {mine: [i], theirs: node})
        if above is None:
            self.root = fork
        else:
            above[1][key] = fork

    def walk(self) -> tuple[list[int], list[int]]:
        """Indices in order, and the common prefix of each with the one before (-1 for the first)."""
        order: list[int] = []
        prefix: list[int] = []
        stack: list[tuple[object, int]] = [(self.root, -1)]
        while stack:
            node, before = stack.pop()
            if isinstance(node, tuple):
                place, below = node
                keys = sorted(below, reverse=True)
                stack.extend((below[c], place) for c in keys[:-1])
                stack.append((below[keys[-1]], before))
            else:
                order += node
                prefix += [before] + [len(self.strings[node[0]])] * (len(node) - 1)
        return order, prefix


def _multikey(keys: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows by group and then by keys[0], keys[1], ..., and where a row begins that differs from the one before it."""
    n = len(group)
    order = np.argsort(group, kind="stable")
    head = np.ones(n, bool)
    head[1:] = group[order][1:] != group[order][:-1]
    level = np.zeros(n, np.int64)
    while True:
        first = np.flatnonzero(head)
        size = np.diff(np.append(first, n))
        open_ = (size > 1) & (level[first] < len(keys))
        if not open_.any():
            return order, head
        at = np.flatnonzero(np.repeat(open_, size))
        size = size[open_]
        part = np.repeat(np.arange(len(size)), size)
        begin = np.cumsum(size) - size
        rows = order[at]
        key = keys[level[at], rows]
        x, y, z = key[begin], key[begin + size // 2], key[begin + size - 1]
        pivot = np.maximum(np.minimum(x, y), np.minimum(np.maximum(x, y), z))[part]
        side = (key > pivot).astype(np.int64) + (key >= pivot)
        by = np.argsort(part * 3 + side, kind="stable")
        order[at], side = rows[by], side[by]
        level[at] += side == 1
        # Rows of a part stand together, and the parts in their order.
        head[at[1:][(side[1:] != side[:-1]) & (part[1:] == part[:-1])]] = True


def sort(strings: list[bytes], group: np.ndarray, shallow: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings within each group, and the common prefix with the one before it (-1 at a group's start)."""
    n = len(strings)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    depth = shallow // DIGIT
    padded = b"".join(s[:shallow].ljust(shallow, b"\0") for s in strings)
    digits = np.frombuffer(padded, ">u8").reshape(n, depth).astype(np.uint64)
    size = np.minimum(np.fromiter(map(len, strings), np.int64, n), shallow)
    order, head = _multikey(np.concatenate([digits.T, size.astype(np.uint64)[None]]), group)
    differ = digits[order[1:]] ^ digits[order[:-1]]
    digit = (differ != 0).argmax(axis=1)
    x = differ[np.arange(n - 1), digit]
    same = np.zeros(n - 1, np.int64)
    for b in range(1, DIGIT):
        same += x < np.uint64(1) << np.uint64(8 * b)
    prefix = np.full(n, -1, np.int64)
    # A string that ends early shares no more than it has, whatever its padding says.
    prefix[1:] = np.minimum(np.where(x != 0, digit * DIGIT + same, shallow), np.minimum(size[order[1:]], size[order[:-1]]))
    prefix[1:][group[order[1:]] != group[order[:-1]]] = -1
    bounds = np.append(np.flatnonzero(head), n)
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if hi - lo > 1:
            trie = _Blind(strings)
            for i in order[lo:hi].tolist():
                trie.add(i)
            order[lo:hi], inner = trie.walk()
            prefix[lo + 1 : hi] = inner[1:]
    return order, prefix
