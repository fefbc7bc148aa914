"""Edit scripts as linked nodes that share their prefixes.

A node is one letter more than its parent's script. It keeps a rolling hash of the whole
script and its ancestors at distances of powers of two, so that two scripts are compared
by a search for their longest common prefix in logarithmic time. A prefix that the hashes
call common is verified: the scripts are walked up to the node they share.
"""

from __future__ import annotations

BASE, MODULUS = 1_000_003, (1 << 61) - 1


class Prefixes:
    def __init__(self):
        self.letter: list[int] = [0]
        self.depth: list[int] = [0]
        self.hash: list[int] = [0]
        self.up: list[tuple[int, ...]] = [(0,)]  # node 0 is the empty script

    def push(self, parent: int, letter: int) -> int:
        node = len(self.letter)
        up, k, at = [parent], 0, parent
        while k < len(self.up[at]) and self.depth[at] >= (1 << k):
            at = self.up[at][k]
            up.append(at)
            k += 1
        self.up.append(tuple(up))
        self.letter.append(letter)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * BASE + letter + 1) % MODULUS)
        return node

    def lifted(self, node: int, depth: int) -> int:
        """The node's prefix of ``depth`` letters."""
        while self.depth[node] > depth:
            over = self.depth[node] - depth
            node = self.up[node][min(over.bit_length(), len(self.up[node])) - 1]
        return node

    def less(self, a: int, b: int) -> bool:
        """Is a's script before b's? A script is before those that it begins."""
        if a == b:
            return False
        shorter = self.depth[a] < self.depth[b]
        depth = min(self.depth[a], self.depth[b])
        a, b = self.lifted(a, depth), self.lifted(b, depth)
        if self.hash[a] != self.hash[b]:
            # up to the highest pair of prefixes that differ
            k = max(len(self.up[a]), len(self.up[b])) - 1
            while k >= 0:
                if k < len(self.up[a]) and k < len(self.up[b]):
                    above = self.up[a][k], self.up[b][k]
                    if self.hash[above[0]] != self.hash[above[1]]:
                        a, b = above
                k -= 1
            found = a, b
        else:
            found = None
        # equal hashes do not prove equal scripts: walk to the node that is shared
        x, y = (self.up[a][0], self.up[b][0]) if found else (a, b)
        while x != y:
            if self.letter[x] != self.letter[y]:
                found = x, y
            x, y = self.up[x][0], self.up[y][0]
        if found is None:
            return shorter
        return self.letter[found[0]] < self.letter[found[1]]

    def letters(self, node: int) -> list[int]:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return out[::-1]
