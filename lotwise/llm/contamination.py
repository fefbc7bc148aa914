"""Benchmark decontamination with a distributed positional inverted index.

``build`` stores the postings of every training word: an index of shards, each of some
whole documents, cut from runs of rows so that no text is shuffled. A shard row holds its
distinct terms (64-bit hashes of words), how often each occurs, and all positions by
term. ``search`` takes benchmark windows, orders the terms of each by how often the whole
corpus holds them, and intersects posting lists from the rarest term on: positions of the
rarest, shifted by its place in the window, stay candidates as long as the next term's
list holds them at its own place (exact phrase), or holds a position within reach of the
rarest term's (proximity).

The benchmark is taken in blocks of bounded text, so what a task holds of it is bounded;
blocks are searched one after the other against all shards.

Edge cases: null or empty texts have no words and no hits; items of fewer words than a
window are one window, items without words none; repeated items count once by id; items
without an id mark words but are not counted; repeated and null document ids keep their
rows apart (a row is known by its place in the index); empty tables give an empty index
or no hits; other columns are ignored. Words are compared by 64-bit hashes of whole
words, and a false hit needs such a collision in a run of otherwise equal words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.words import LETTERS_AND_DIGITS, blocks
from lotwise.session import durable

WIDTH = 10
SHARD_WORDS = 1 << 19
QUERY_CHARS = 1 << 21
CANDIDATES = 1 << 21

INDEX = (
    "part int, shard int, doc_ids array<long>, doc_words array<long>, terms array<long>, "
    "counts array<int>, positions binary"
)
FOUND = (
    "part int, shard int, doc_no int, doc_id long, n_words long, n_hit long, "
    "runs array<long>, items array<string>"
)


def names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def build(documents: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """The index, one row per shard, written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, size = TaskContext.get().partitionId(), 0, 0
        hashes: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        ids: list[pa.Array] = []

        def flush() -> pa.RecordBatch:
            term = np.concatenate(hashes)
            order = np.argsort(term, kind="stable")  # positions of a term stay ascending
            ranked = term[order]
            first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))[: len(term)]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([shard], pa.int32()),
                    listed(pa.concat_arrays(ids)),
                    listed(pa.array(np.concatenate(counts))),
                    listed(pa.array(ranked[first].view(np.int64))),
                    listed(pa.array(np.diff(np.append(first, len(term))).astype(np.int32))),
                    pa.array([order.astype("<i4").tobytes()], pa.binary()),
                ],
                names=names(INDEX),
            )

        for batch in batches:
            for block in blocks(batch.column(1), lower=True):
                block.words(LETTERS_AND_DIGITS)
                hashes.append(block.hashes())
                counts.append(np.diff(block.bounds).astype(np.int64))
                ids.append(batch.column(0).slice(block.first, block.n).cast(pa.int64()))
                size += len(hashes[-1])
                if size >= shard_words:
                    yield flush()
                    shard, size = shard + 1, 0
                    hashes.clear()
                    counts.clear()
                    ids.clear()
        if ids:
            yield flush()

    return durable(documents.select("doc_id", "text").mapInArrow(run, INDEX), "postings")


def listed(values: pa.Array) -> pa.Array:
    """One row that holds all values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


class Windows:
    """The windows of some items; ``hashes`` are the items' words one after the other."""

    def __init__(self, items: pa.Table, width: int):
        texts = items["text"].combine_chunks() if len(items) else pa.array([], pa.string())
        self.items = items["item_id"].to_pylist()
        words, start, size, item = [], [], [], []
        done = 0
        for block in blocks(texts, lower=True):
            block.words(LETTERS_AND_DIGITS)
            words.append(block.hashes())
            n = np.diff(block.bounds)
            count = np.where(n >= width, n - width + 1, (n > 0).astype(np.int64))
            text = np.repeat(np.arange(block.n), count)
            nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
            start.append(done + block.bounds[text] + nth)
            size.append(np.minimum(n, width)[text])
            item.append(block.first + text)
            done += len(words[-1])
        join = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
        self.hashes = join(words, np.uint64)
        self.start, self.size, self.item = (join(x, np.int64) for x in (start, size, item))
        self.terms, self.term = np.unique(self.hashes, return_inverse=True)
        self.width = width

    def ordered(self, frequency: np.ndarray) -> None:
        """Set ``places``: of each window, the places of its words, rarest first."""
        place = np.arange(self.width)
        at = np.minimum(self.start[:, None] + place, max(len(self.hashes) - 1, 0))
        count = frequency[self.term[at]] if len(self.hashes) else np.zeros(at.shape)
        count[place >= self.size[:, None]] = np.iinfo(np.int64).max
        self.places = np.argsort(count, axis=1, kind="stable").astype(np.uint8)


def frequencies(index: DataFrame, windows: Windows) -> np.ndarray:
    """How often the corpus holds each term of the windows."""
    wanted = index.sparkSession.sparkContext.broadcast(windows.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, total = wanted.value, np.zeros(len(wanted.value), np.int64)
        for batch in batches:
            for have, counts in zip(batch.column(0), batch.column(1), strict=True):
                have = have.values.to_numpy().view(np.uint64)
                counts = counts.values.to_numpy()
                at = np.minimum(np.searchsorted(have, terms), max(len(have) - 1, 0))
                if len(have):
                    total += np.where(have[at] == terms, counts[at], 0)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen, pa.int64()), pa.array(total[seen])], names=["term", "n"]
        )

    out = np.zeros(len(windows.terms), np.int64)
    rows = index.select("terms", "counts").mapInArrow(run, "term long, n long")
    table = rows.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out[table["term"].to_numpy()] = table["n"].to_numpy()
    return out


class Shard:
    """One row of the index, ready for lookups."""

    def __init__(self, row: dict):
        self.terms = row["terms"].values.to_numpy().view(np.uint64)
        self.counts = row["counts"].values.to_numpy().astype(np.int64)
        self.positions = np.frombuffer(row["positions"].as_buffer(), "<i4").astype(np.int64)
        self.first = np.cumsum(self.counts) - self.counts
        self.n = len(self.positions)
        self.doc_ids = row["doc_ids"].values
        self.doc_words = row["doc_words"].values.to_numpy()
        self.doc_ends = np.cumsum(self.doc_words)
        # (term, position) as one ascending number
        self.keys = np.repeat(np.arange(len(self.terms)), self.counts) * self.n + self.positions

    def documents(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.doc_ends, position, side="right")

    def next(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        """The first position of the term from there on; the shard's size if none."""
        at = np.searchsorted(self.keys, term * self.n + position)
        key = self.keys[np.minimum(at, len(self.keys) - 1)]
        return np.where((at < len(self.keys)) & (key // self.n == term), key % self.n, self.n)

    def matches(
        self, windows: Windows, slack: int | None
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Window, start and end of matches; ``slack`` None asks for exact phrases."""
        if not self.n or not len(windows.start):
            return
        at = np.minimum(np.searchsorted(self.terms, windows.terms), len(self.terms) - 1)
        own = np.where(self.terms[at] == windows.terms, at, -1)[windows.term]
        missing = np.concatenate([[0], np.cumsum(own < 0)])
        ends = windows.start + windows.size
        whole = np.flatnonzero(missing[ends] == missing[windows.start])
        if not len(whole):
            return
        rarest = own[windows.start[whole] + windows.places[whole, 0]]
        size = self.counts[rarest]
        group = np.cumsum(size) // CANDIDATES
        for g in np.unique(group):
            mine = group == g
            window = np.repeat(whole[mine], size[mine])
            run = np.cumsum(size[mine]) - size[mine]
            nth = np.arange(len(window)) - np.repeat(run, size[mine])
            anchor = self.positions[np.repeat(self.first[rarest[mine]], size[mine]) + nth]
            begin = anchor - windows.places[window, 0]
            width = windows.size[window]
            doc = self.documents(anchor)
            head, tail = self.doc_ends[doc] - self.doc_words[doc], self.doc_ends[doc]
            if slack is None:
                low, high = begin, begin + width
                keep = (low >= head) & (high <= tail)
            else:
                low = np.maximum(anchor - width - slack + 1, head)
                high = np.minimum(anchor + width + slack, tail)
                keep = np.ones(len(low), bool)
            window, begin, low, high = window[keep], begin[keep], low[keep], high[keep]
            for k in range(1, windows.width):
                place = windows.places[window, k].astype(np.int64)
                real = np.flatnonzero(place < windows.size[window])
                term = own[windows.start[window[real]] + place[real]]
                if slack is None:
                    wanted = begin[real] + place[real]
                    held = self.next(term, wanted) == wanted
                else:
                    held = self.next(term, low[real]) < high[real]
                keep = np.ones(len(window), bool)
                keep[real] = held
                window, begin, low, high = window[keep], begin[keep], low[keep], high[keep]
            if len(window):
                yield window, low, high


def found(
    index: DataFrame, windows: Windows, slack: int | None, only_hits: bool
) -> DataFrame:
    """One row per document (or per hit document) with its hit words and items."""
    shared = index.sparkSession.sparkContext.broadcast(windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                shard = Shard(row)
                cover = np.zeros(shard.n + 1, np.int64)
                pairs = [np.zeros((0, 2), np.int64)]
                for window, low, high in shard.matches(windows, slack):
                    np.add.at(cover, low, 1)
                    np.add.at(cover, high, -1)
                    both = np.stack([shard.documents(low), windows.item[window]], 1)
                    pairs.append(np.unique(both, axis=0))
                inside = np.cumsum(cover[:-1]) > 0
                edge = np.concatenate([[0], np.cumsum(shard.doc_words)])
                hit = np.concatenate([[0], np.cumsum(inside)])
                n_hit = hit[edge[1:]] - hit[edge[:-1]]
                items: list[list[str]] = [[] for _ in n_hit]
                runs: list[list[int]] = [[] for _ in n_hit]
                for doc, item in np.unique(np.concatenate(pairs), axis=0).tolist():
                    if windows.items[item] is not None:
                        items[doc].append(windows.items[item])
                for doc in np.flatnonzero(n_hit).tolist():
                    own = np.concatenate([[0], inside[edge[doc] : edge[doc + 1]], [0]])
                    runs[doc] = np.flatnonzero(np.diff(own.astype(np.int8))).tolist()
                rows = np.flatnonzero(n_hit) if only_hits else np.arange(len(n_hit))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"].as_py()] * len(rows), pa.int32()),
                        pa.array([row["shard"].as_py()] * len(rows), pa.int32()),
                        pa.array(rows, pa.int32()),
                        shard.doc_ids.take(pa.array(rows)),
                        pa.array(shard.doc_words[rows]),
                        pa.array(n_hit[rows]),
                        pa.array([runs[d] for d in rows], pa.list_(pa.int64())),
                        pa.array([sorted(set(items[d])) for d in rows], pa.list_(pa.string())),
                    ],
                    names=names(FOUND),
                )

    return index.mapInArrow(run, FOUND)


def merged(rows: DataFrame) -> DataFrame:
    """Rows of one document from several blocks of items, as one row."""
    whole = rows.groupBy("part", "shard", "doc_no").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("n_words").alias("n_words"),
        F.collect_list("runs").alias("lists"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unions = []
            for lists in batch.column("lists").to_pylist():
                spans = sorted(s for x in lists for s in zip(x[::2], x[1::2], strict=True))
                union: list[int] = []
                for a, b in spans:
                    if union and a <= union[-1]:
                        union[-1] = max(union[-1], b)
                    else:
                        union += [a, b]
                unions.append(union)
            hit = [sum(x[1::2]) - sum(x[::2]) for x in unions]
            own = {"runs": pa.array(unions, pa.list_(pa.int64())), "n_hit": pa.array(hit, pa.int64())}
            yield pa.RecordBatch.from_arrays(
                [own[c] if c in own else batch.column(c) for c in names(FOUND)],
                names=names(FOUND),
            )

    return whole.mapInArrow(run, FOUND)


def search(
    index: DataFrame,
    items: DataFrame,
    width: int = WIDTH,
    slack: int | None = None,
    query_chars: int = QUERY_CHARS,
) -> DataFrame:
    """Of every document: its words, hit words, their runs and the items found in it.

    Without ``slack`` a window matches as an exact phrase. With it, a window matches
    where all its terms lie within its width and ``slack`` words more of an occurrence
    of its rarest term; the words in that reach count as hit.
    """
    items = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    chars = items.agg(F.sum(F.length("text") + 1)).first()[0] or 0
    parts = -(-chars // query_chars) or 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    out = None
    for b in range(parts):
        windows = Windows(items.where(block == b).toArrow(), width)
        windows.ordered(frequencies(index, windows))
        rows = found(index, windows, slack, only_hits=b > 0)
        out = rows if out is None else out.unionByName(rows)
    return merged(out) if parts > 1 else out


def report(documents: DataFrame, items: DataFrame, slack: int | None = None) -> DataFrame:
    """Hits of every document as counts, and the found items as one hash."""
    rows = search(build(documents), items, slack=slack)
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
