"""Simple-8b, a word-aligned code of unsigned integers.

A 64-bit word holds a selector in its top four bits and as many ids as its selector
says in the other sixty:

| selector | 0 | 1 | 2 | 3 | 4 | 5 | 6 | 7 | 8 | 9 | 10 | 11 | 12 | 13 | 14 | 15 |
| ids      | 240 zeros | 60 | 30 | 20 | 15 | 12 | 10 | 8 | 7 | 6 | 5 | 4 | 3 | 2 | 1 | 1 |
| bits     | 0 | 1 | 2 | 3 | 4 | 5 | 6 | 7 | 8 | 10 | 12 | 15 | 20 | 30 | 60 | escape |

Selector 15 is the escape for an id of more than sixty bits: the word holds its low
sixty bits, and its top four are a byte in the block's list of escapes.

A segment is: the magic ``S8B1``; uint32 block size; uint64 number of ids; uint32 number
of blocks; per block the uint32 offset of its first word and of its first escape byte,
and one pair more for the ends; the words; the escape bytes. All little-endian. Ids are
cut into blocks of equal size, each coded alone, so that any block decodes by itself and
all blocks of a segment decode together, selector by selector.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"S8B1"
BLOCK = 4096
#: Ids and bits by selector.
COUNTS = np.array([240, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1])
WIDTHS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 60])
ESCAPE = 15
LOW = np.uint64((1 << 60) - 1)
HEADER = struct.Struct("<4sIQI")


def selectors(bits: np.ndarray) -> np.ndarray:
    """By block and position, the selector that takes most ids from there on."""
    n = bits.shape[1] - int(COUNTS[0])
    largest, width, top = bits, 1, {}
    sizes = sorted({int(c) for c in COUNTS})
    for size in sizes:  # the largest bit length among the next ``size`` ids
        while width < size:
            step = min(width, size - width)
            largest = np.maximum(largest[:, : largest.shape[1] - step], largest[:, step:])
            width += step
        top[size] = largest[:, :n]
    out = np.full((bits.shape[0], n), ESCAPE, np.uint8)
    for s in range(ESCAPE - 1, -1, -1):
        np.copyto(out, np.uint8(s), where=top[int(COUNTS[s])] <= int(WIDTHS[s]))
    return out


def encode(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """A segment of these unsigned ids."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n, blocks = len(ids), -(-len(ids) // block)
    padded = np.zeros((blocks, block + int(COUNTS[0])), np.uint64)
    whole = np.zeros(blocks * block, np.uint64)
    whole[:n] = ids
    padded[:, :block] = whole.reshape(blocks, block)
    # rounding up makes a bit length one too large at most, which costs room only
    bits = np.frexp(padded.astype(np.float64))[1].astype(np.uint8)
    chosen = selectors(bits)
    sizes = np.minimum(n - np.arange(blocks) * block, block)
    taken = []
    counts = COUNTS.astype(np.uint8)[chosen]
    for i, size in enumerate(sizes.tolist()):  # where a block's words begin
        step, at = counts[i].tobytes(), 0
        while at < size:
            taken.append(i * block + at)
            at += step[at]
    place = np.array(taken, np.int64)
    row, column = place // block, place % block
    selector = chosen[row, column].astype(np.int64)
    words = selector.astype(np.uint64) << np.uint64(60)
    flat, first = padded.ravel(), row * padded.shape[1] + column
    for s in range(1, ESCAPE + 1):
        mine = np.flatnonzero(selector == s)
        if len(mine):
            begin, found = first[mine], words[mine]
            for i in range(int(COUNTS[s])):
                found |= (flat[begin + i] & LOW) << np.uint64(i * int(WIDTHS[s]))
            words[mine] = found
    escaped = selector == ESCAPE
    escapes = (padded[row[escaped], column[escaped]] >> np.uint64(60)).astype(np.uint8)
    edges = np.arange(blocks + 1)
    offsets = np.stack([np.searchsorted(row, edges), np.searchsorted(row[escaped], edges)], 1)
    return b"".join(
        [
            HEADER.pack(MAGIC, block, n, blocks),
            offsets.astype("<u4").tobytes(),
            words.astype("<u8").tobytes(),
            escapes.tobytes(),
        ]
    )


def decode(data: bytes, first_block: int = 0, last_block: int | None = None) -> np.ndarray:
    """The ids of a segment, or of its blocks ``first_block`` to ``last_block`` - 1."""
    magic, block, n, blocks = HEADER.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a segment of Simple-8b")
    last_block = blocks if last_block is None else last_block
    offsets = np.frombuffer(data, "<u4", 2 * (blocks + 1), HEADER.size).reshape(-1, 2)
    body = HEADER.size + offsets.nbytes
    (a, x), (b, y) = offsets[first_block].tolist(), offsets[last_block].tolist()
    words = np.frombuffer(data, "<u8", b - a, body + 8 * a)
    escapes = np.frombuffer(data, np.uint8, y - x, body + 8 * int(offsets[-1, 0]) + x)
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selector]
    per_block = np.diff(offsets[first_block : last_block + 1, 0].astype(np.int64))
    row = np.repeat(np.arange(last_block - first_block), per_block)
    before = np.cumsum(counts) - counts
    if len(words):
        heads = np.cumsum(per_block) - per_block
        before = before - before[heads][row] + row * block
    size = min(n, last_block * block) - first_block * block
    ends = np.minimum((row + 1) * block, size)
    out = np.zeros(max(size, 0), np.uint64)
    for s in range(1, ESCAPE + 1):
        mine = np.flatnonzero(selector == s)
        if len(mine):
            span = np.arange(COUNTS[s])
            place = before[mine, None] + span
            mask = np.uint64((1 << int(WIDTHS[s])) - 1)
            values = (words[mine, None] >> (span * WIDTHS[s]).astype(np.uint64)) & mask
            if s == ESCAPE:
                values = values | (escapes.astype(np.uint64)[:, None] << np.uint64(60))
            inside = place < ends[mine, None]
            out[place[inside]] = values[inside]
    return out
