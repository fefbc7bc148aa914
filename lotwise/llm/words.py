"""Words of whole texts as numpy arrays, for operators that run on Arrow batches.

A block holds some texts of one Arrow batch in one byte buffer, a blank after each.
Words are found by a table of the bytes that belong to words, and hashed to 64 bits
eight bytes at a time. Words of at most eight bytes and equal length never collide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
K = np.uint64(0x9E3779B97F4A7C15)

ALL_BUT_BLANKS = np.ones(256, bool)
ALL_BUT_BLANKS[[0x20, *range(0x09, 0x0E)]] = False

LETTERS_AND_DIGITS = np.zeros(256, bool)
LETTERS_AND_DIGITS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Block:
    """Texts ``first`` to ``first + n - 1`` of a batch; nulls read as empty."""

    def __init__(self, texts: pa.Array, first: int, lower: bool = False):
        padded = pc.binary_join_element_wise(
            texts.cast(pa.large_binary()), pa.scalar(b" ", pa.large_binary()),
            pa.scalar(b"", pa.large_binary()), null_handling="replace", null_replacement=b"",
        )
        _, ends, data = padded.buffers()
        self.first, self.n = first, len(padded)
        self.offsets = np.frombuffer(ends, np.int64)[padded.offset : padded.offset + self.n + 1]
        start = self.offsets[0]
        self.offsets = self.offsets - start
        size = int(self.offsets[-1])
        # eight bytes more, so that a word's last eight bytes can be read at once
        self.bytes = np.zeros(size + 8, np.uint8)
        self.bytes[:size] = np.frombuffer(data, np.uint8)[start : start + size]
        if lower:
            self.bytes = LOWER[self.bytes]
        self.size = size

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sum of a value per byte, by text."""
        total = np.concatenate([[0], np.cumsum(values[: self.size], dtype=np.int64)])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def words(self, kind: np.ndarray) -> None:
        """Set ``starts`` and ``ends`` of words, and ``bounds``: word numbers by text."""
        inside = np.zeros(self.size + 1, np.int8)
        inside[1:] = kind[self.bytes[: self.size]]
        edges = np.flatnonzero(np.diff(inside))
        # every text ends with a blank, so the edges come in pairs
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.bounds = np.searchsorted(self.starts, self.offsets)

    def hashes(self) -> np.ndarray:
        size = self.ends - self.starts
        eights = np.ndarray(
            (self.size + 1,), np.dtype("<u8"), buffer=self.bytes.data, strides=(1,)
        )
        out = mix(size.astype(np.uint64))
        active, done = np.arange(len(size)), 0
        long = size > 512
        if long.any():
            active = np.flatnonzero(~long)
            for i in np.flatnonzero(long):  # junk without blanks
                out[i] = long_hash(self.bytes[self.starts[i] : self.ends[i]].tobytes())
        while len(active):
            left = np.minimum(size[active] - done, 8).astype(np.uint64)
            chunk = eights[self.starts[active] + done]
            chunk = chunk & (np.uint64(0xFFFFFFFFFFFFFFFF) >> ((np.uint64(8) - left) << np.uint64(3)))
            out[active] = mix(out[active] * K + chunk)
            done += 8
            active = active[size[active] > done]
        return out

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), np.diff(self.bounds))

    def room(self) -> np.ndarray:
        """For each word, the number of words from it to the end of its text."""
        counts = np.diff(self.bounds)
        return np.repeat(self.bounds[1:], counts) - np.arange(len(self.starts))


def long_hash(word: bytes) -> np.uint64:
    import hashlib

    return np.uint64(int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little"))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words, by its first word (shorter by width - 1)."""
    n = max(0, len(hashes) - width + 1)
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out = out * K + hashes[j : j + n]
    return mix(out)


def hash_words(words: list[bytes]) -> np.ndarray:
    """The hashes that a block gives to these words."""
    if not words:
        return np.zeros(0, np.uint64)
    block = Block(pa.array(words, pa.large_binary()), 0)
    block.starts, block.ends = block.offsets[:-1], block.offsets[1:] - 1
    return block.hashes()


def blocks(texts: pa.Array, lower: bool = False, most: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a batch where the texts reach ``most`` bytes; a text is never cut."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes, dtype=np.int64) // most
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), len(sizes)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield Block(texts.slice(a, b - a), a, lower)
