"""Weighted acyclic automata of word n-grams: a path is an n-gram, its weight a count.

In memory the paths stand as a tree in sorted order: each level holds its nodes' parents,
symbols and weights, so a level is built, united and searched by whole arrays. Written
down, states with the same way on (the same arcs with the same weights and targets) are
one state, found from the leaves up in a register of what is known; agreement of hashes
is verified arc by arc. Level 0 holds tags (languages), levels 1 to 3 words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lotwise.llm.words import Block, K, mix

DEPTH = 3
CODEC = "zstd"


def names(values: list | pa.Array) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values, pa.large_binary())


def spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each count, one after the other."""
    ends = np.cumsum(counts)
    return np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)


def sorted_names(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct names in byte order, and the place of each value among them."""
    coded = values.dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    place = np.empty(len(order), np.int64)
    place[order.to_numpy()] = np.arange(len(order))
    return coded.dictionary.take(order), place[coded.indices.to_numpy(zero_copy_only=False)]


def hashes(values: pa.Array) -> np.ndarray:
    if not len(values):
        return np.zeros(0, np.uint64)
    block = Block(values, 0)
    block.starts, block.ends = block.offsets[:-1], block.offsets[1:] - 1
    return block.hashes()


def grouped(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, their summed weights, and where each key went."""
    distinct, place = np.unique(keys, return_inverse=True)
    # exact: sums stay far below 2^53
    sums = np.bincount(place, weights, len(distinct)).astype(np.int64)
    return distinct, sums, place


def registered(counts: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """A class for each state, and each class's first state: states of one class have the
    same arcs."""
    n = len(counts)
    starts = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(n), counts)
    print_ = np.zeros(len(owner), np.uint64)
    for column in columns:
        print_ = mix(print_ * K + column.astype(np.uint64))
    total = np.concatenate([[np.uint64(0)], np.cumsum(print_, dtype=np.uint64)])
    state = mix(total[starts + counts] - total[starts] + mix(counts.astype(np.uint64)))
    _, first, kind = np.unique(state, return_index=True, return_inverse=True)
    model = first[kind]
    same = np.array_equal(counts[model], counts)
    if same:
        there = np.arange(len(owner)) - starts[owner] + starts[model[owner]]
        same = all(np.array_equal(column[there], column) for column in columns)
    return (kind, first) if same else (np.arange(n), np.arange(n))


class Counts:
    """Weights of n-grams of up to three words, by tag."""

    def __init__(self, tags: pa.Array, words: pa.Array, levels: list[tuple]):
        self.tags, self.words = names(tags), names(words)
        self.levels = levels  # (parent, symbol, weight), sorted by parent and symbol

    @classmethod
    def built(cls, tags, words, grams: list[tuple[list[np.ndarray], np.ndarray]]) -> Counts:
        """From n-grams by size: columns of symbols (tag, word, ...) and weights; equal
        n-grams are summed."""
        tags, words = names(tags), names(words)
        width = max(len(words), 1)
        place = [np.zeros(len(w), np.int64) for _, w in grams]
        levels = []
        for depth in range(DEPTH + 1):
            live = [i for i, (columns, _) in enumerate(grams) if len(columns) > depth]
            keys = [place[i] * (width if depth else max(len(tags), 1)) + grams[i][0][depth] for i in live]
            weights = [grams[i][1] if len(grams[i][0]) == depth + 1 else np.zeros(len(grams[i][1]), np.int64) for i in live]
            distinct, sums, to = grouped(
                np.concatenate(keys) if keys else np.zeros(0, np.int64),
                np.concatenate(weights) if weights else np.zeros(0, np.int64),
            )
            parent, symbol = np.divmod(distinct, width if depth else max(len(tags), 1))
            levels.append((parent, symbol, sums))
            for i, part in zip(live, np.split(to, np.cumsum([len(k) for k in keys])[:-1]), strict=False):
                place[i] = part
        return cls(tags, words, levels)

    def columns(self, depth: int) -> list[np.ndarray]:
        """Symbols of all nodes of a level, from the tag on."""
        out, at = [], np.arange(len(self.levels[depth][0]))
        for level in range(depth, -1, -1):
            parent, symbol, _ = self.levels[level]
            out.append(symbol[at])
            at = parent[at]
        return out[::-1]

    def grams(self, least: int = 1) -> list[tuple[list[np.ndarray], np.ndarray]]:
        """n-grams of sizes 1 to 3 with at least this weight."""
        out = []
        for depth in range(1, DEPTH + 1):
            held = np.flatnonzero(self.levels[depth][2] >= least)
            out.append(([c[held] for c in self.columns(depth)], self.levels[depth][2][held]))
        return out

    @classmethod
    def union(cls, parts: list[Counts]) -> Counts:
        """The n-grams of all parts, weights summed."""
        tags, tag_at = sorted_names(pa.concat_arrays([p.tags for p in parts]))
        words, word_at = sorted_names(pa.concat_arrays([p.words for p in parts]))
        by_size: list[list] = [[] for _ in range(DEPTH)]
        t = w = 0
        for p in parts:
            own_tags, own_words = tag_at[t : t + len(p.tags)], word_at[w : w + len(p.words)]
            t, w = t + len(p.tags), w + len(p.words)
            for size, (columns, weights) in enumerate(p.grams()):
                by_size[size].append(([own_tags[columns[0]], *(own_words[c] for c in columns[1:])], weights))
        grams = []
        for size, found in enumerate(by_size):
            columns = [np.concatenate([f[0][i] for f in found]) for i in range(size + 2)]
            grams.append((columns, np.concatenate([f[1] for f in found])))
        return cls.built(tags, words, grams)

    def kept(self, least: int) -> Counts:
        """Only the n-grams with at least this weight, and their words."""
        return Counts.built(self.tags, self.words, self.grams(least)).trimmed()

    def trimmed(self) -> Counts:
        """Without names that no path uses."""
        used = np.unique(np.concatenate([symbol for _, symbol, _ in self.levels[1:]]))
        of_tags = np.unique(self.levels[0][1])
        levels = [(self.levels[0][0], np.searchsorted(of_tags, self.levels[0][1]), self.levels[0][2])]
        levels += [(p, np.searchsorted(used, s), w) for p, s, w in self.levels[1:]]
        return Counts(self.tags.take(pa.array(of_tags)), self.words.take(pa.array(used)), levels)

    def composed(self, asked: Counts) -> list[np.ndarray]:
        """For each level's nodes of ``asked``, in its order, their weight here (0: none)."""
        tag_at = pc.fill_null(pc.index_in(asked.tags, value_set=self.tags), -1).to_numpy().astype(np.int64)
        word_at = pc.fill_null(pc.index_in(asked.words, value_set=self.words), -1).to_numpy().astype(np.int64)
        out, place = [], None
        for depth, (parent, symbol, _) in enumerate(asked.levels):
            own_parent, own_symbol, weight = self.levels[depth]
            width = max(len(self.words) if depth else len(self.tags), 1)
            above = place[parent] if depth else np.zeros(len(symbol), np.int64)
            below = (word_at if depth else tag_at)[symbol]
            keys, own = above * width + below, own_parent * width + own_symbol
            at = np.searchsorted(own, keys)
            hit = (above >= 0) & (below >= 0) & (at < len(own))
            hit[hit] = own[at[hit]] == keys[hit]
            place = np.where(hit, at, -1)
            found = np.zeros(len(symbol), np.int64)
            found[hit] = weight[at[hit]]
            out.append(found)
        return out

    # --- as bytes ---

    def packed(self) -> bytes:
        """The automaton with shared states, compressed."""
        kids = [np.bincount(self.levels[d + 1][0], minlength=len(self.levels[d][0])) for d in range(DEPTH)]
        arrays, targets = [], []
        for depth in range(DEPTH, 0, -1):
            _, symbol, weight = self.levels[depth]
            counts = kids[depth - 1]
            kind, first = registered(counts, [symbol, weight, *targets])
            arcs = spans((np.cumsum(counts) - counts)[first], counts[first])
            arrays = [counts[first], symbol[arcs], weight[arcs], *(x[arcs] for x in targets), *arrays]
            targets = [kind]
        arrays = [self.levels[0][1], targets[0], *arrays]
        return bundled([*arrays, *name_arrays(self.tags), *name_arrays(self.words)])

    @classmethod
    def unpacked(cls, data: bytes) -> Counts:
        arrays = unbundled(data)
        root, state = arrays[:2]
        levels = [(np.zeros(len(root), np.int64), root, np.zeros(len(root), np.int64))]
        at = 2
        for depth in range(1, DEPTH + 1):
            counts, symbol, weight = arrays[at : at + 3]
            at += 3
            arcs = spans((np.cumsum(counts) - counts)[state], counts[state])
            parent = np.repeat(np.arange(len(state)), counts[state])
            levels.append((parent, symbol[arcs], weight[arcs]))
            if depth < DEPTH:
                state = arrays[at][arcs]
                at += 1
        return cls(array_names(*arrays[at : at + 2]), array_names(*arrays[at + 2 : at + 4]), levels)


def name_arrays(values: pa.Array) -> list[np.ndarray]:
    if not len(values):
        return [np.zeros(0, np.int64), np.zeros(0, np.uint8)]
    _, ends, data = values.buffers()
    ends = np.frombuffer(ends, np.int64)[values.offset : values.offset + len(values) + 1]
    own = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.zeros(0, np.uint8)
    return [np.diff(ends), own]


def array_names(lengths: np.ndarray, data: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    buffers = [None, pa.py_buffer(ends), pa.py_buffer(data.astype(np.uint8).tobytes())]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), buffers)


def bundled(arrays: list[np.ndarray]) -> bytes:
    """Arrays of numbers >= 0, each in the least width that holds it."""
    head, body = [len(arrays)], []
    for a in arrays:
        most = int(a.max()) if len(a) else 0
        width = next(w for w in (1, 2, 4, 8) if most < 1 << 8 * w)
        head += [len(a), width]
        body.append(a.astype(f"<u{width}").tobytes())
    raw = np.array(head, "<i8").tobytes() + b"".join(body)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec=CODEC, asbytes=True)


def unbundled(data: bytes) -> list[np.ndarray]:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec=CODEC, asbytes=True)
    n = int.from_bytes(raw[:8], "little")
    head = np.frombuffer(raw, "<i8", 2 * n, 8)
    out, at = [], 8 + 16 * n
    for size, width in zip(head[::2], head[1::2], strict=True):
        a = np.frombuffer(raw, f"<u{width}", size, at)
        out.append(a.astype(np.int64))
        at += int(size) * int(width)
    return out
