"""Deep-shallow sorting of strings of one width inside one buffer.

Shallow: multikey quicksort by eight bytes at a time, as whole arrays: of the strings that
still stand together each round sorts only those, by their next eight bytes. Deep: what is
equal down to ``SHALLOW`` bytes is ordered by blind tries, whose nodes keep a depth and the
branching bytes alone: a string goes down by those, is compared once with the string it
meets, and is hung in where the two part.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 48


class BlindTrie:
    """Strings of one width; equal ones share a leaf."""

    def __init__(self, width: int):
        self.width, self.root = width, None

    def add(self, text: bytes, number: int) -> None:
        node = self.root
        if node is None:
            self.root = (text, [number])
            return
        while len(node) == 3:  # depth, children, and any leaf below
            node = node[1].get(text[node[0]]) or node[2]
        met, numbers = node
        if met == text:
            numbers.append(number)
            return
        differ = int.from_bytes(met, "big") ^ int.from_bytes(text, "big")
        depth = self.width - (differ.bit_length() + 7) // 8
        leaf = (text, [number])
        above, node = None, self.root
        while len(node) == 3 and node[0] < depth:
            above, node = node, node[1][text[node[0]]]
        if len(node) == 3 and node[0] == depth:
            node[1][text[depth]] = leaf
            return
        inner = (depth, {met[depth]: node, text[depth]: leaf}, leaf)
        if above is None:
            self.root = inner
        else:
            above[1][text[above[0]]] = inner

    def classes(self):
        """The numbers of equal strings, in the order of the strings."""
        waiting = [self.root] if self.root else []
        while waiting:
            node = waiting.pop()
            if len(node) == 2:
                yield node[1]
            else:
                waiting += [node[1][k] for k in sorted(node[1], reverse=True)]


def deep_shallow(data: bytes, starts: np.ndarray, groups: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings at ``starts`` by group, then bytes, and for each string (as it
    came in) a number that it shares with its equals in the group alone."""
    n = len(starts)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    padded = np.frombuffer(data + b"\0" * 8, np.uint8)
    eights = np.ndarray((len(data) + 1,), np.dtype(">u8"), buffer=padded.data, strides=(1,))
    shallow = min(SHALLOW, width) // 8 * 8
    order = np.argsort(groups, kind="stable")
    kind = np.cumsum(np.concatenate([[0], np.diff(groups[order]) != 0]))  # by place in the order
    for depth in range(0, shallow, 8):
        sizes = np.bincount(kind)
        open_ = np.flatnonzero(sizes[kind] > 1)
        if not len(open_):
            break
        mine, chunk = kind[open_], eights[starts[order[open_]] + depth].astype(np.uint64)
        turned = np.lexsort((chunk, mine))
        order[open_] = order[open_[turned]]
        mine, chunk = mine[turned], chunk[turned]
        breaks = np.zeros(n, np.int64)
        breaks[open_[1:]] = (mine[1:] == mine[:-1]) & (chunk[1:] != chunk[:-1])
        kind = kind + np.cumsum(breaks)
    sizes = np.bincount(kind)
    begins = np.cumsum(sizes) - sizes
    number = np.empty(n, np.int64)
    number[order] = begins[kind]
    for k in np.flatnonzero(sizes > 1):
        at = begins[k]
        members = order[at : at + sizes[k]].tolist()
        trie = BlindTrie(width)
        for m in members:
            a = starts[m]
            trie.add(data[a : a + width], m)
        for equal in trie.classes():
            order[at : at + len(equal)] = equal
            number[equal] = at
            at += len(equal)
    return order, number
