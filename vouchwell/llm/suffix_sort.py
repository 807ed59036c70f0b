"""Deep-shallow sorting of byte strings that share long prefixes.

A multikey quicksort on words of eight bytes orders the strings to a shallow depth. What is
equal to that depth has a long common prefix, and a blind trie, which stores branching depths
and bytes but no strings, orders it: an insertion follows the branching bytes to any leaf,
compares with that one string, and branches at the depth where they differ.
"""

from __future__ import annotations

SHALLOW = 32
WORD = 8


def common_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the longest common prefix of two strings equal up to ``start``."""
    most = min(len(a), len(b))
    if a[start:most] == b[start:most]:
        return most
    low, high = start, most  # equal up to low, different up to high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class _Node:
    __slots__ = ("depth", "children", "leaf")

    def __init__(self, depth: int, leaf: int) -> None:
        self.depth, self.leaf, self.children = depth, leaf, {}


def _byte(text: bytes, depth: int) -> int:
    return text[depth] if depth < len(text) else -1


def _blind_trie(texts: list[bytes], rows: list[int], start: int) -> tuple[list[int], list[int]]:
    """(rows in order, common prefix of each with the row before) of rows equal up to ``start``."""
    root = _Node(len(texts[rows[0]]), rows[0])
    equal: dict[int, list[int]] = {rows[0]: []}
    for row in rows[1:]:
        text, node = texts[row], root
        while node.children:  # blindly, by the branching bytes alone
            node = node.children.get(_byte(text, node.depth)) or next(iter(node.children.values()))
        other = texts[node.leaf]
        shared = common_prefix(text, other, start)
        if shared == len(text) == len(other):
            equal[node.leaf].append(row)
            continue
        equal[row] = []
        above, node = None, root
        while node.children and node.depth < shared:
            above, node = node, node.children[_byte(text, node.depth)]
        if node.children and node.depth == shared:
            node.children[_byte(text, shared)] = _Node(len(text), row)
            continue
        branch = _Node(shared, node.leaf)
        branch.children = {_byte(other, shared): node, _byte(text, shared): _Node(len(text), row)}
        if above is None:
            root = branch
        else:
            above.children[_byte(text, above.depth)] = branch
    order, shared = [], []
    waiting = [(root, start)]  # a node, and what its first leaf shares with the leaf before
    while waiting:
        node, before = waiting.pop()
        if node.children:
            keys = sorted(node.children)
            waiting += [(node.children[k], node.depth) for k in reversed(keys[1:])]
            waiting.append((node.children[keys[0]], before))
        else:
            order.append(node.leaf)
            shared.append(before)
            order += equal[node.leaf]
            shared += [len(texts[node.leaf])] * len(equal[node.leaf])
    return order, shared


def deep_shallow(texts: list[bytes], start: int = 0) -> tuple[list[int], list[int]]:
    """(order, shared): the sorted rows, and the common prefix of each with the one before (0 for the first).

    The strings are equal up to ``start``.
    """
    order: list[int] = []
    shared: list[int] = []
    limit = start + SHALLOW
    waiting = [(list(range(len(texts))), start, 0)]
    while waiting:
        rows, depth, before = waiting.pop()
        if len(rows) == 1:
            order.append(rows[0])
            shared.append(before)
        elif depth >= limit:
            own, within = _blind_trie(texts, rows, depth)
            order += own
            shared += [before, *within[1:]]
        elif rows:
            words = {row: texts[row][depth : depth + WORD] for row in rows}
            pivot = words[rows[len(rows) // 2]]
            low = [row for row in rows if words[row] < pivot]
            same = [row for row in rows if words[row] == pivot]
            high = [row for row in rows if words[row] > pivot]
            # What follows another part shares the words' common prefix with its last row, at most a
            # word; the exact value comes from comparing the two rows that meet, below.
            waiting += [(high, depth, -1), (same, depth + WORD if len(pivot) == WORD else limit, -1 if low else before)]
            if low:
                waiting.append((low, depth, before))
    for place, value in enumerate(shared):
        if value < 0:
            shared[place] = common_prefix(texts[order[place - 1]], texts[order[place]], start)
    return order, shared
