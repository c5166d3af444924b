"""Deep-shallow sorting of byte strings: multikey quicksort, then blind tries for what stays equal long.

`order_with_lcp` sorts strings and gives the common prefix of neighbours. Multikey quicksort looks at
eight bytes at a time and stops at the shallow depth. Groups equal up to there go into a blind trie,
which holds only branching depths and bytes: a string is looked up blindly, compared once with the
leaf found, and put in where it parts.
"""

from __future__ import annotations

CHUNK = 8


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if not n:
        return 0
    differing = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differing.bit_length() + 7) // 8


class _Branch:
    __slots__ = ("depth", "children")

    def __init__(self, depth: int):
        self.depth, self.children = depth, {}


def _at(s: bytes, depth: int) -> int:
    return s[depth] if depth < len(s) else -1


def blind_trie(strings: list[bytes], which: list[int]) -> list[int]:
    """`which` in the order of the strings it names; equal strings in the order given."""
    root: _Branch | list[int] = [which[0]]
    for i in which[1:]:
        s, node = strings[i], root
        while isinstance(node, _Branch):
            node = node.children.get(_at(s, node.depth)) or next(iter(node.children.values()))
        other = strings[node[0]]
        depth = common(s, other)
        if depth == len(s) == len(other):
            node.append(i)
            continue
        above, node = None, root
        while isinstance(node, _Branch) and node.depth < depth:
            above, node = node, node.children[_at(s, node.depth)]
        if not (isinstance(node, _Branch) and node.depth == depth):
            split = _Branch(depth)
            split.children[_at(other, depth)] = node
            if above is None:
                root = split
            else:
                above.children[_at(s, above.depth)] = split
            node = split
        node.children[_at(s, depth)] = [i]
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, _Branch):
            stack += [node.children[c] for c in sorted(node.children, reverse=True)]
        else:
            out += node
    return out


def deep_shallow(strings: list[bytes], depth: int = 0, shallow: int = 32) -> list[int]:
    """Sorted order of strings that agree in their first `depth` bytes."""
    out: list[int] = []
    stack = [(list(range(len(strings))), depth)]
    while stack:
        which, at = stack.pop()
        if len(which) < 2:
            out += which
        elif at >= shallow:
            out += blind_trie(strings, which)
        else:
            keys = [strings[i][at : at + CHUNK] for i in which]
            pivot = sorted((keys[0], keys[len(keys) // 2], keys[-1]))[1]
            low = [i for i, k in zip(which, keys) if k < pivot]
            same = [i for i, k in zip(which, keys) if k == pivot]
            high = [i for i, k in zip(which, keys) if k > pivot]
            ended = len(pivot) < CHUNK  # then all of `same` are the same string
            stack.append((high, at))
            stack += [([i], at) for i in reversed(same)] if ended else [(same, at + CHUNK)]
            stack.append((low, at))
    return out


def order_with_lcp(strings: list[bytes], depth: int = 0, shallow: int = 32) -> tuple[list[int], list[int]]:
    """Sorted order, and the common prefix of each string in it with the one before (-1 for the first)."""
    order = deep_shallow(strings, depth, shallow)
    return order, [-1] + [common(strings[a], strings[b]) for a, b in zip(order, order[1:])]
