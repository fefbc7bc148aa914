"""Lexical retrieval packing over the whole table.

Documents are packed into sequences of ``WINDOW`` tokens by BM25 over token ids. The
number of documents, their mean length and every token's document count are those of
the whole table. A document's heaviest terms (by its own BM25 weights) deal it out: rows
are sorted by them over all partitions, so that related documents, wherever they lay,
meet in one shard: a run of sorted rows, bounded in tokens and in documents. In a shard
the next seed queries an inverted index; its unused neighbours, best first, fill the
seed's window whole as long as they fit. What is then left of the window takes the head
of the best unused neighbour, whose tail is the next seed. So a window holds at most one
cut, and none is padded.

There are ``ROUNDS`` rounds. In all but the last, only related neighbours count (a score
of ``RELATED`` of the smaller own score) and only full windows are kept; a seed without
enough of them, and every document not used, goes to the next round, which deals by the
next heaviest terms and so meets other documents. The last round deals by the heaviest
terms again and fills windows with the best that its shard holds. A shard's last, partly
filled window is then cut into sequences whose lengths are powers of two, which need no
padding either.

Edge cases: a null or empty text is a document of one end id; equal documents are
packed each on its own; a text longer than the window fills windows alone and its rest
is a seed; an empty table gives no piece; null ids are kept; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.tokens import encoder, public_path
from lotwise.session import durable

WINDOW = 4096
SHARD_TOKENS = 1 << 20
SHARD_DOCUMENTS = 1 << 14
ROWS_AT_ONCE = 2000
ROUNDS = 3
RELATED = 0.25
K1, B = 1.2, 0.75
KEY_TERMS, KEY_BITS = 3, 21

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)
# what is left of a document: its ids from ``start`` on, as bytes
REST = "doc_id long, row long, doc_tokens long, start long, ids binary"
Piece = tuple[int, int, int, int, int]  # document, start, length, sequence, offset


def names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def counted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different ids, ascending, and how often each occurs."""
    ranked = np.sort(ids)
    new = np.ones(len(ids) + 1, bool)
    np.not_equal(ranked[1:], ranked[:-1], out=new[1:-1])
    first = np.flatnonzero(new)
    return ranked[first[:-1]], first[1:] - first[:-1]


def id_type(path: str) -> str:
    return "<u2" if encoder(path).tokenizer.get_vocab_size() <= 1 << 16 else "<u4"


@dataclass
class Statistics:
    """Of the whole table: documents, their mean length, documents by token id."""

    n: int
    mean: float
    df: np.ndarray

    def __post_init__(self):
        self.idf = np.log1p((self.n - self.df + 0.5) / (self.df + 0.5)).astype(np.float32)
        # a term of one document finds no neighbour; one of most documents tells nothing
        self.useful = (self.df > 1) & (2 * self.df <= max(self.n, 4))

    def weights(self, terms: np.ndarray, tf: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        norm = K1 * (1 - B + B * length / self.mean)
        return self.idf[terms] * (tf * (K1 + 1) / (tf + norm)).astype(np.float32)

    def heaviest(self, ids: np.ndarray, n: int) -> np.ndarray:
        """The first ``n`` useful terms of a document, by falling weight; of equal ones the lower id."""
        terms, tf = counted(ids)
        keep = self.useful[terms]
        terms, tf = terms[keep], tf[keep]
        weights = -self.weights(terms, tf, len(ids))
        if n < len(terms):  # only what may be among the first is sorted
            keep = weights <= np.partition(weights, n)[n]
            terms, weights = terms[keep], weights[keep]
        return terms[np.argsort(weights, kind="stable")][:n]

    def key(self, ids: np.ndarray, skip: int) -> int:
        """What deals a document out: KEY_TERMS of its heaviest terms, after ``skip``."""
        out = 0
        chosen = self.heaviest(ids, skip + KEY_TERMS)[skip:].tolist()
        for t in [t + 1 for t in chosen] + [0] * (KEY_TERMS - len(chosen)):
            out = out << KEY_BITS | t
        return out


class Index:
    """BM25 over the documents of a shard; every score is final, as they don't change."""

    def __init__(self, documents: list[np.ndarray], statistics: Statistics):
        found = [counted(x) for x in documents]
        keep = [statistics.useful[t] for t, _ in found]
        self.terms = [t[k] for (t, _), k in zip(found, keep, strict=True)]
        term = np.concatenate(self.terms)
        tf = np.concatenate([c[k] for (_, c), k in zip(found, keep, strict=True)]).astype(np.float32)
        sizes = np.array([len(t) for t in self.terms])
        doc = np.repeat(np.arange(len(documents)), sizes)
        length = np.array([len(x) for x in documents], np.float32)
        weight = statistics.weights(term, tf, length[doc])
        self.own = np.bincount(doc, weight, minlength=len(documents))
        order = np.argsort(term, kind="stable")
        self.vocabulary, self.first, self.df = np.unique(term[order], return_index=True, return_counts=True)
        self.doc, self.weight, self.n = doc[order].astype(np.int32), weight[order], len(documents)

    def scores(self, seed: int) -> np.ndarray:
        at = np.searchsorted(self.vocabulary, self.terms[seed])
        size = self.df[at]
        if not len(at):
            return np.zeros(self.n)
        start = np.repeat(self.first[at] - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
        postings = start + np.arange(len(start))
        return np.bincount(self.doc[postings], self.weight[postings], minlength=self.n)


def fitting(order: np.ndarray, length: np.ndarray, room: int) -> np.ndarray:
    """The documents that fit whole, each tried in its turn."""
    out = [order[:0]]
    while room and len(order):
        order = order[length[order] <= room]
        total = np.cumsum(length[order])
        n = int(np.searchsorted(total, room, "right"))
        if n:
            out.append(order[:n])
            room -= int(total[n - 1])
        order = order[n:]
    return np.concatenate(out)


def pack(
    documents: list[np.ndarray],
    statistics: Statistics,
    left: list[tuple[int, int]],
    window: int = WINDOW,
    last: bool = True,
) -> Iterator[Piece]:
    """Pieces of a shard's documents, sequence numbers from 0.

    Unless ``last``, only related documents share a window; the documents that found
    too few go to ``left``, with where their rest begins.
    """
    if not documents:
        return
    index = Index(documents, statistics)
    length = np.array([len(x) for x in documents], np.int64)
    used = np.zeros(len(documents), bool)
    sequence, seed, begin, following = 0, -1, 0, 0
    while True:
        if seed < 0:
            while following < len(used) and used[following]:
                following += 1
            if following == len(used):
                break
            seed, begin, following = following, 0, following + 1
            used[seed] = True
        while length[seed] - begin >= window:
            yield seed, begin, window, sequence, 0
            sequence, begin = sequence + 1, begin + window
        if length[seed] == begin:
            seed = -1
            continue
        pieces = [(seed, begin, int(length[seed] - begin))]
        room = window - pieces[0][2]
        scores, free = index.scores(seed), ~used
        if not last:
            free &= (scores > 0) & (scores >= RELATED * np.minimum(index.own[seed], index.own))
        order = np.flatnonzero(free)
        if not last and length[order].sum() < room:
            if begin:
                left.append((seed, begin))
            else:
                used[seed] = False  # it may still follow another seed
            seed = -1
            continue
        # best first; of equal scores the earlier row
        order = order[np.argsort(-scores[order], kind="stable")]
        seed = -1
        whole = fitting(order, length, room)
        used[whole] = True
        pieces += [(int(d), 0, int(length[d])) for d in whole]
        room -= int(length[whole].sum())
        if room:
            rest = order[~used[order]]
            if len(rest):
                seed, begin = int(rest[0]), room
                used[seed] = True
                pieces.append((seed, 0, room))
                room = 0
        filled = window - room
        for size in [window] if not room else [1 << b for b in range(31, -1, -1) if filled >> b & 1]:
            offset = 0
            while offset < size:
                doc, start, piece = pieces[0]
                take = min(piece, size - offset)
                yield doc, start, take, sequence, offset
                offset += take
                pieces[0] = (doc, start + take, piece - take)
                if take == piece:
                    pieces.pop(0)
            sequence += 1
    left += [(int(d), 0) for d in np.flatnonzero(~used)]


def encoded(documents: DataFrame, path: str) -> DataFrame:
    """Every document with its ids, as REST says, numbered; and of each task a row without
    number, whose ``df`` counts the task's documents by token id."""
    columns = [*names(REST), "df"]
    kinds = [*[pa.int64()] * 4, pa.binary(), pa.binary()]

    def rows(*values) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(values, kinds, strict=True)], names=columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, kind = encoder(path), id_type(path)
        row = TaskContext.get().partitionId() << 33
        df, last = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int64)
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(first, ROWS_AT_ONCE)
                ids = list(encode.each(part.column(1)))
                for own in ids:
                    while own.max() >= len(df):
                        df, last = np.append(df, np.zeros_like(df)), np.append(last, last)
                    place = np.arange(len(own))
                    last[own] = place  # an id counts once, at one of its places
                    df[own[last[own] == place]] += 1
                n = len(ids)
                numbers, sizes = range(row, row + n), [len(x) for x in ids]
                held = [x.astype(kind).tobytes() for x in ids]
                yield rows(part.column(0).cast(pa.int64()), numbers, sizes, [0] * n, held, [None] * n)
                row += n
        yield rows([None], [None], [None], [None], [None], [df[: np.flatnonzero(df).max(initial=-1) + 1].tobytes()])

    return documents.select("doc_id", "text").mapInArrow(run, f"{REST}, df binary")


def statistics_of(rests: DataFrame, path: str) -> Statistics:
    """Counted over all documents while they were encoded (``path``: by which tokenizer);
    only one count a token id reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in batch.column(0):
                df = np.frombuffer(own.as_buffer(), np.int32).astype(np.int64)
                seen = np.flatnonzero(df)
                yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(df[seen])], names=["token", "df"])

    counts = rests.where("row is null").select("df").mapInArrow(run, "token long, df long")
    found = counts.groupBy("token").agg(F.sum("df").alias("df")).toArrow()
    n, tokens = rests.agg(F.count("row"), F.coalesce(F.sum("doc_tokens"), F.lit(0))).first()
    token = found["token"].to_numpy()
    df = np.zeros(int(token.max()) + 1 if len(token) else 1, np.int64)
    df[token] = found["df"].to_numpy()
    return Statistics(n, max(tokens / max(n, 1), 1.0), df)


def dealt(rests: DataFrame, shared, skip: int, partitions: int, path: str) -> DataFrame:
    """The rows with their ``key``, sorted by it over all partitions; rows of one key by number.
    What a round left has its key already, and bounds are found without reading ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, statistics = id_type(path), shared.value
        for batch in batches:
            ids = batch.column(names(REST).index("ids"))
            keys = [statistics.key(np.frombuffer(x.as_py(), kind), skip) for x in ids]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())], names=[*names(REST), "key"])

    keyed = rests
    if "key" not in rests.columns:
        keyed = rests.where("row is not null").select(*names(REST)).mapInArrow(run, f"{REST}, key long")
    return keyed.repartitionByRange(partitions, "key", "row").sortWithinPartitions("key", "row")


def one_round(
    rests: DataFrame, shared, number: int, rounds: int, path: str, window: int, shard_tokens: int, shard_documents: int
) -> DataFrame:
    """Pieces, and rows of what is left, which have ids, the next round's key and no sequence."""
    schema = f"{SCHEMA}, row long, ids binary, key long"
    last = number == rounds - 1
    skip, following = (0 if n >= rounds - 1 else n for n in (number, number + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, statistics = id_type(path), shared.value
        base = number << 60 | TaskContext.get().partitionId() << 33
        rows: list[dict] = []
        shard: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal base
            left: list[tuple[int, int]] = []
            out = []
            for d, start, size, sequence, offset in pack(shard, statistics, left, window, last):
                crc = zlib.crc32(shard[d][start : start + size].astype("<u4").tobytes())
                own = rows[d]
                at = own["start"] + start
                out.append((own["doc_id"], at, size, crc, own["doc_tokens"], base + sequence, offset, own["row"], None, None))
            base += max((x[5] - base for x in out), default=-1) + 1
            for d, start in left:
                own, ids = rows[d], shard[d][start:]
                at = own["start"] + start
                key = statistics.key(ids, following)
                out.append((own["doc_id"], at, len(ids), None, own["doc_tokens"], None, None, own["row"], ids.tobytes(), key))
            kinds = [pa.int64()] * 8 + [pa.binary(), pa.int64()]
            if out:
                columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names(schema))
            rows.clear()
            shard.clear()

        tokens = 0
        for batch in batches:
            for row in batch.to_pylist():
                shard.append(np.frombuffer(row.pop("ids"), kind))
                rows.append(row)
                tokens += len(shard[-1])
                if tokens >= shard_tokens or len(shard) >= shard_documents:
                    yield from flush()
                    tokens = 0
        if shard:
            yield from flush()

    tokens = rests.agg(F.coalesce(F.sum(F.col("doc_tokens") - F.col("start")), F.lit(0))).first()[0]
    return dealt(rests, shared, skip, max(1, math.ceil(tokens / shard_tokens)), path).mapInArrow(run, schema)


def packed(
    documents: DataFrame,
    path: str | None = None,
    window: int = WINDOW,
    shard_tokens: int = SHARD_TOKENS,
    shard_documents: int = SHARD_DOCUMENTS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per piece of every document."""
    path = path or public_path()
    rests = durable(encoded(documents, path), "tokens")
    shared = documents.sparkSession.sparkContext.broadcast(statistics_of(rests, path))
    found = []
    for number in range(rounds):
        out = one_round(rests, shared, number, rounds, path, window, shard_tokens, shard_documents)
        if number < rounds - 1:
            out = durable(out, "round")
            rests = out.where("ids is not null").select(*names(REST), "key")
        found.append(out.where("ids is null").select(*names(SCHEMA)))
    pieces = found[0]
    for more in found[1:]:
        pieces = pieces.unionByName(more)
    return pieces
