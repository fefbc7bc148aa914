"""Token ids of whole texts, by a public tokenizer of the tokenizers library.

Words repeat, so their ids are kept: a text is cut at ASCII blanks, which the tokenizer
drops and no token crosses. Texts are taken in blocks of some megabytes, of which each
different word is looked up once. A word that is not known yet and consists of plain Latin
characters is cut by the tokenizer's own split pattern, and each piece goes to the
library's model; any other word goes through the library whole. What is kept is bounded:
letter pieces are arrays, of which those of the latest block stay when the bound is
reached; of other words the older half is forgotten.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END = 2
MOST_KEPT = 50_000
MOST_PIECES = 400_000
BLOCK_BYTES = 1 << 22

# Fixed values of the tokenizer file: its split pattern, written for the characters of
# PLAIN, and the byte alphabet's shift for the bytes that Latin letters consist of.
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+\Z")
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
LETTERS_AND_ONE = r"^[A-Za-zÀ-ÖØ-öø-ÿ]+[!-@\[-`{-~]?$"
OTHER_BYTES = frozenset(b for b in range(0x21, 0x7F) if not chr(b).isalpha())
OTHERS = "".join(map(chr, sorted(OTHER_BYTES)))


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


# array("I") is what the files and checksums hold
assert array("I").itemsize == 4 and sys.byteorder == "little"


class Kept(dict):
    """A dictionary that computes what it lacks, and forgets what was long not used."""

    def __init__(self, compute):
        super().__init__()
        self.compute, self.older = compute, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= MOST_KEPT:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def buffers(texts: pa.Array) -> tuple[bytes, list[int]]:
    """The bytes of all texts, and where each begins and the last ends."""
    ends = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)])
    first = int(np.frombuffer(texts.buffers()[1], np.int32)[texts.offset]) if len(texts) else 0
    return texts.buffers()[2].slice(first, int(ends[-1])).to_pybytes() if ends[-1] else b"", ends.tolist()


def joined(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(values), "<u4"), np.fromiter(map(len, values), np.int64, len(values)) // 4


def taken(ids: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of these rows, of which ``sizes`` says how many each has."""
    counts = sizes[rows]
    start = (np.cumsum(sizes) - sizes)[rows] - (np.cumsum(counts) - counts)
    return ids[np.repeat(start, counts) + np.arange(int(counts.sum()))], counts


class Pieces:
    """Letter pieces and their ids as flat arrays: some bytes a piece, looked up at once.
    What is new is computed as ``kept`` does it."""

    def __init__(self, kept: Kept, most: int = MOST_PIECES):
        self.kept, self.most = kept, most
        self.known = pa.array([], pa.string())
        self.ids, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def places(self, pieces: pa.Array) -> np.ndarray:
        """Where ``sizes`` has each of these different pieces."""
        at = pc.index_in(pieces, value_set=self.known)
        missing = at.is_null().to_numpy(zero_copy_only=False)
        at = at.fill_null(0).to_numpy().astype(np.int64)
        new = pieces.filter(pa.array(missing))
        if len(self.known) + len(new) > self.most:
            self.ids, self.sizes = taken(self.ids, self.sizes, at[~missing])
            self.known = pieces.filter(pa.array(~missing))
            at[~missing] = np.arange(len(self.known))
        at[missing] = len(self.known) + np.arange(len(new))
        ids, sizes = joined([*map(self.kept.compute, new.to_pylist())])
        self.ids, self.sizes = np.concatenate([self.ids, ids]), np.concatenate([self.sizes, sizes])
        self.known = pa.concat_arrays([self.known, new])
        return at


class Encoder:
    """Texts to ids as little-endian unsigned 32-bit bytes, END not appended."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.alphabet = byte_alphabet()
        self.words, self.pieces = Kept(self.word), Kept(self.piece)
        self.heads = Pieces(self.pieces)
        self.special = re.compile(
            "|".join(re.escape(x.content) for x in self.tokenizer.get_added_tokens_decoder().values())
            or "(?!)"
        )

    def piece(self, text: str) -> bytes:
        if not text.isascii():
            text = text.encode().decode("latin-1").translate(self.alphabet)
        return array("I", [x.id for x in self.model.tokenize(text)]).tobytes()

    def word(self, raw: bytes) -> bytes:
        if raw.isalpha():  # of ASCII letters
            return self.pieces[raw.lower().decode()]
        if raw[:-1].isalpha() and 0x20 < raw[-1] < 0x7F:
            pieces = self.pieces
            return pieces[raw[:-1].lower().decode()] + pieces[chr(raw[-1])]
        text = raw.decode()
        if PLAIN.match(text) and not self.special.search(text):
            return b"".join(map(self.pieces.__getitem__, PIECES.findall(text.lower())))
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __call__(self, text: bytes) -> bytes:
        return b"".join(map(self.words.__getitem__, text.split()))

    def of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and how many each has. Words of Latin letters, with one more
        character at most, are parted as a whole array."""
        plain = pc.match_substring_regex(words, LETTERS_AND_ONE)
        lower = pc.utf8_lower(words.filter(plain))
        coded = pc.utf8_rtrim(lower, OTHERS).dictionary_encode()
        heads = self.heads.places(coded.dictionary)
        data, ends = buffers(lower)
        tails = np.frombuffer(data, np.uint8)[np.array(ends[1:], np.int64) - 1] if len(lower) else np.zeros(0, np.uint8)
        rest = [self.words[w] if w else b"" for w in words.filter(pc.invert(plain)).cast(pa.binary()).to_pylist()]
        ones = [self.pieces[chr(b)] if b in OTHER_BYTES else b"" for b in range(256)]
        ids, sizes = joined([*ones, *rest])
        # each word is one of the known and a tail
        known = len(self.heads.sizes)
        sides = np.full((len(words), 2), known)
        is_plain = plain.to_numpy(zero_copy_only=False)
        sides[is_plain, 0] = heads[coded.indices.to_numpy()]
        sides[is_plain, 1] += tails
        sides[~is_plain, 0] = known + 256 + np.arange(len(rest))
        ids, sizes = np.concatenate([self.heads.ids, ids]), np.concatenate([self.heads.sizes, sizes])
        ids, sizes = taken(ids, sizes, sides.ravel())
        return ids, sizes.reshape(-1, 2).sum(axis=1)

    def ended(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, END after each text, and where the ids of each end."""
        words = pc.ascii_split_whitespace(texts)  # with empty words at the ends
        coded = words.flatten().dictionary_encode()
        ids, sizes = self.of_words(coded.dictionary)
        ids, sizes = np.append(ids, np.uint32(END)), np.append(sizes, 1)
        last = np.cumsum(pc.list_value_length(words).to_numpy() + 1) - 1
        word = np.full(len(coded) + len(texts), len(sizes) - 1)
        of_text = np.ones(len(word), bool)
        of_text[last] = False
        word[of_text] = coded.indices.to_numpy()
        ids, sizes = taken(ids, sizes, word)
        return ids, np.cumsum(sizes)[last]

    def each(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text (null: empty), with END."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        total = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64))
        first = 0
        while first < len(texts):
            before = int(total[first - 1]) if first else 0
            after = max(first + 1, int(np.searchsorted(total, before + BLOCK_BYTES, "right")))
            ids, ends = self.ended(texts.slice(first, after - first))
            yield from np.split(ids, ends[:-1])
            first = after
        # a block's arrays are many times its texts: what they took is given back
        pa.default_memory_pool().release_unused()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder a worker and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def public_path(name: str = "word_bpe_49k.json") -> str:
    """The place of a public tokenizer's file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
