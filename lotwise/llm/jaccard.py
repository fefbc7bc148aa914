"""N-gram Jaccard join by prefixes of single tokens and token combinations.

A document's set holds its distinct 5-word shingles as 64-bit hashes (the tokens); equal
sets are one node. Tokens have one global order: rare ones by hash, then frequent ones
by document frequency. Two sets of Jaccard similarity 0.75 differ in at most a quarter
of either set's tokens. So a prefix in which rare tokens count 1 each and a class of
frequent tokens counts its size less 1 must, once the counts exceed that quarter, share
with any similar set either a rare token or two tokens of one class. Rare tokens are
indexed alone; frequent tokens, for which the prefix is extended, as pairs within
classes whose number follows the set's size.

Frequencies are exact counts over the prefixes (in hash order) of all documents; a token
is frequent from ``LEAST_FREQUENT`` on, or from the share of all counted tokens that
leaves at most ``MOST_FREQUENT`` of them, which bounds what is broadcast. Which tokens
are called frequent never changes the result, only the work.

Signatures that a map task sees several times are passed on beside the shuffle and only
one marker a task is dealt out by signature, so a signature of very many sets arrives as
one row a task. Links are found without making all pairs of a group: first each set is
compared with the best of its signatures' leaders, and the links found join sets to
components; then only pairs of different components matter. In signatures of many sets
those are found by comparing bitmaps within blocks, first the best pair of each
component, in the end all that are left; in signatures of few sets they are joined.
A parity bitmap of two bits a token bounds the overlap from above, so whole sets travel
only for pairs that may be links, and every link is settled by comparing whole sets;
they are made anew from the texts whose hash says that they may be wanted. No table of
pairs grows with the square of a group: of a block only the sets that have a pair are
named, they are sent there whole, and the block hands on a forest of its links.

Edge cases: null texts and texts without words have an empty set, no link, and are a
component of their own (their doc_id); texts of fewer than five words have one shingle;
repeated rows are one node; null ids are never a component's smallest id unless nothing
else is in it; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.components import components, extended
from lotwise.llm.words import ALL_BUT_BLANKS, K, Block, blocks, mix, windows
from lotwise.session import durable

SHINGLE = 5
PERCENT = 75
LEAST_FREQUENT = 32
MOST_FREQUENT = 1 << 20
CHUNK = 1 << 19
SMALL = 32
BLOCK = 4096
TOKENS = 512
ROUNDS = 1

SETS = "doc_id long, n_shingles long, node long, bits binary, text_hash long"
SIGNED = "key long, signature long, node long, size int, kind byte"
SINGLE, MARKER, PASSED = 0, 1, 2
FILTER_WORDS = 1 << 18


class Sets:
    """The token sets of a block: ``tokens`` ascending by text, texts from ``bounds``."""

    def __init__(self, block: Block):
        block.words(ALL_BUT_BLANKS)
        hashes, text = block.hashes(), block.text_of_word()
        counts = np.diff(block.bounds)
        at = np.flatnonzero(block.room() >= SHINGLE)
        token, text = windows(hashes, SHINGLE)[at], text[at]
        short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
        if len(short):
            whole = [
                mix(windows(hashes[block.bounds[i] : block.bounds[i + 1]], int(counts[i])) + K)
                for i in short
            ]
            token, text = np.concatenate([token, *whole]), np.concatenate([text, short])
        order = np.lexsort((token, text))
        token, text = token[order], text[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (text[1:] != text[:-1])
        self.tokens, self.text = token[new], text[new]
        self.sizes = np.bincount(self.text, minlength=block.n)
        self.bounds = np.concatenate([[0], np.cumsum(self.sizes)])
        # an order-free digest of the set, and its size
        total = self.sums(mix(self.tokens ^ K))
        other = self.sums(mix(self.tokens + K) * K)
        self.nodes = mix(mix(total) + other * K + self.sizes.astype(np.uint64)).view(np.int64)

    def sums(self, values: np.ndarray) -> np.ndarray:
        running = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values, out=running[1:])
        return running[self.bounds[1:]] - running[self.bounds[:-1]]

    def of(self, i: int) -> np.ndarray:
        return self.tokens[self.bounds[i] : self.bounds[i + 1]]


def prefix(sizes: np.ndarray) -> np.ndarray:
    """How many tokens a prefix of single tokens takes."""
    return np.where(sizes > 0, sizes - -(-PERCENT * sizes // 100) + 1, 0)


def bitmap(tokens: np.ndarray) -> bytes:
    """Parities of the tokens' counts in a power of two of bins, two bins a token."""
    bins = max(64, 1 << int(2 * len(tokens) - 1).bit_length())
    odd = np.bincount((tokens & np.uint64(bins - 1)).astype(np.int64), minlength=bins) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def overlap_bound(a: bytes, b: bytes, sizes: int) -> int:
    """An upper bound of the overlap of two sets whose sizes add up to ``sizes``."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return (sizes - int(np.bitwise_count(x ^ y).sum())) // 2


def similar(overlap: int, sizes: int) -> bool:
    return 100 * overlap >= PERCENT * (sizes - overlap)


def sets_of(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, node (null for an empty set), bits, and the text's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1), lower=True):
                own = Sets(block)
                empty = own.sizes == 0
                bits = [None if e else bitmap(own.of(i)) for i, e in enumerate(empty)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(block.first, block.n).cast(pa.int64()),
                        pa.array(own.sizes),
                        pa.array(own.nodes, mask=empty),
                        pa.array(bits, pa.binary()),
                        batch.column(2).slice(block.first, block.n),
                    ],
                    names=[c.split()[0] for c in SETS.split(", ")],
                )

    return documents.select("doc_id", "text", F.xxhash64("text")).mapInArrow(run, SETS)


def fresh(own: Sets, seen: set[int]) -> np.ndarray:
    """Texts of at least two tokens whose set this task has not met before."""
    out = np.zeros(len(own.sizes), bool)
    for i in np.flatnonzero(own.sizes > 1).tolist():
        node = int(own.nodes[i])
        if node not in seen:
            seen.add(node)
            out[i] = True
    return out


def frequent_tokens(documents: DataFrame, counted: int) -> tuple[np.ndarray, np.ndarray]:
    """The frequent tokens, ascending, and their counts; ``counted``: tokens in prefixes."""
    least = max(LEAST_FREQUENT, counted // MOST_FREQUENT + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            token, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(token.view(np.int64)), pa.array(n)], names=["token", "n"]
            )

        for batch in batches:
            for block in blocks(batch.column(0), lower=True):
                own = Sets(block)
                rank = np.arange(len(own.tokens)) - own.bounds[own.text]
                keep = (rank < prefix(own.sizes)[own.text]) & fresh(own, seen)[own.text]
                held.append(own.tokens[keep])
                size += len(held[-1])
                if size >= CHUNK:
                    yield flush()
                    held.clear()
                    size = 0
        if held:
            yield flush()

    rows = documents.select("text").mapInArrow(run, "token long, n long")
    # at most MOST_FREQUENT rows: each has ``least`` of the ``counted`` tokens
    table = rows.groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= least).toArrow()
    token = table["token"].to_numpy().view(np.uint64)
    order = np.argsort(token)
    return token[order], table["n"].to_numpy()[order]


class Frequent:
    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        self.tokens, self.counts = tokens, counts
        self.mask = np.uint64((1 << 20) - 1)
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(tokens & self.mask).astype(np.int64)] = True

    def of(self, tokens: np.ndarray) -> np.ndarray:
        """Count of each token, 0 for rare ones."""
        out = np.zeros(len(tokens), np.int64)
        maybe = np.flatnonzero(self.seen[(tokens & self.mask).astype(np.int64)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.tokens, tokens[maybe]), len(self.tokens) - 1)
            out[maybe] = np.where(self.tokens[at] == tokens[maybe], self.counts[at], 0)
        return out


def step(size: int) -> int:
    """Sets of similarity 0.75 are in the same step of sizes or in neighbouring ones."""
    b, top = 0, 1
    while top < size:
        top = max(top + 1, top * 100 // PERCENT)
        b += 1
    return b


def floor_of(b: int) -> int:
    """The smallest size in step ``b``."""
    top, below = 1, 0
    for _ in range(b):
        top, below = max(top + 1, top * 100 // PERCENT), top
    return below + 1


def combinations(tokens: np.ndarray, counts: np.ndarray, size: int, needed: int) -> np.ndarray:
    """Signatures of pairs of frequent tokens; ``needed``: what rare tokens leave over."""
    order = np.lexsort((tokens, counts))
    tokens, out = tokens[order], []
    own = step(size)
    for b in (own, own + 1):  # a similar set shares one of the two
        classes = max(1, floor_of(max(b - 1, 0)) // 8)
        kind = (mix(tokens + np.uint64(b)) % np.uint64(classes)).astype(np.int64)
        _, first = np.unique(kind, return_index=True)
        counted = np.ones(len(tokens), np.int64)
        counted[first] = 0
        end = int(np.searchsorted(np.cumsum(counted), needed)) + 1
        token, kind = tokens[:end], kind[:end]
        by = np.lexsort((token, kind))
        token, kind = token[by], kind[by]
        apart = 1
        while apart < len(token):  # the pairs within classes, by their distance
            same = np.flatnonzero(kind[apart:] == kind[:-apart])
            if not len(same):
                break
            pair = token[same] * K + token[same + apart]
            out.append(mix(mix(pair) + np.uint64(b)))
            apart += 1
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def signatures(own: Sets, use: np.ndarray, frequent: Frequent) -> tuple[np.ndarray, np.ndarray]:
    """Signatures and their texts, for the texts to ``use``."""
    counts = frequent.of(own.tokens)
    rare = counts == 0
    before = np.concatenate([[0], np.cumsum(rare)])
    rank = before[:-1] - before[own.bounds[own.text]]
    needed = prefix(own.sizes)
    take = rare & (rank < needed[own.text]) & use[own.text]
    signature, text = [own.tokens[take]], [own.text[take]]
    lacking = needed - (before[own.bounds[1:]] - before[own.bounds[:-1]])
    for i in np.flatnonzero(use & (lacking > 0)).tolist():
        span = slice(own.bounds[i], own.bounds[i + 1])
        often = ~rare[span]
        pairs = combinations(
            own.tokens[span][often], counts[span][often], int(own.sizes[i]), int(lacking[i])
        )
        signature.append(pairs)
        text.append(np.full(len(pairs), i))
    return np.concatenate(signature), np.concatenate(text)


def groups(signature: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by signature, the groups' starts in it, and their sizes."""
    order = np.argsort(signature, kind="stable")
    ranked = signature[order]
    new = np.ones(len(ranked), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    start = np.flatnonzero(new)
    return order, start, np.diff(np.append(start, len(ranked)))


def shared_signatures(documents: DataFrame, frequent: Frequent) -> DataFrame:
    """signature, node, size: the signatures that two nodes or more have."""
    known = documents.sparkSession.sparkContext.broadcast(frequent)
    columns = [c.split()[0] for c in SIGNED.split(", ")]

    def emit(key, signature, node, size, kind) -> pa.RecordBatch:
        kinds = np.full(len(key), kind, np.int8) if np.isscalar(kind) else kind
        arrays = (key.view(np.int64), signature.view(np.int64), node, size, kinds)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=columns)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, seen = known.value, set()
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        total = 0

        def flush() -> Iterator[pa.RecordBatch]:
            signature, node, size = (np.concatenate(x) for x in zip(*held, strict=True))
            order, start, count = groups(signature)
            alone = order[start[count == 1]]
            yield emit(signature[alone], signature[alone], node[alone], size[alone], SINGLE)
            first = order[start[count > 1]]
            if len(first):
                yield emit(signature[first], signature[first], node[first], size[first], MARKER)
                several = order[np.repeat(count > 1, count)]
                s, n = signature[several], node[several]
                yield emit(mix(s + n.view(np.uint64) * K), s, n, size[several], PASSED)

        for batch in batches:
            for block in blocks(batch.column(0), lower=True):
                own = Sets(block)
                signature, text = signatures(own, fresh(own, seen), frequent)
                held.append((signature, own.nodes[text], own.sizes[text].astype(np.int32)))
                total += len(signature)
                if total >= CHUNK:
                    yield from flush()
                    held.clear()
                    total = 0
        if total:
            yield from flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone = []
        for batch in batches:
            passed = batch.filter(pa.array(batch.column("kind").to_numpy() == PASSED))
            if passed.num_rows:
                yield passed.select(["signature", "node", "size"])
            rest = batch.filter(pa.array(batch.column("kind").to_numpy() != PASSED))
            if rest.num_rows:
                alone.append(rest)
        if alone:
            table = pa.Table.from_batches(alone)
            signature = table["signature"].to_numpy()
            order, _, count = groups(signature)
            several = np.sort(order[np.repeat(count > 1, count)])
            table = table.take(pa.array(several))
            table = table.filter(pa.array(table["kind"].to_numpy() == SINGLE))
            yield from table.select(["signature", "node", "size"]).combine_chunks().to_batches()

    signed = documents.select("text").mapInArrow(sign, SIGNED).repartition("key")
    shared = signed.mapInArrow(meet, "signature long, node long, size int")
    # a set met in two tasks, or sharing a signature only with itself
    return shared.distinct()


def possible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """a, b, bound: the pairs whose bitmaps leave room for a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            out = []
            for a, b, n, m, x, y in zip(*(rows[c] for c in ("a", "b", "n", "m", "x", "y")), strict=True):
                bound = min(overlap_bound(x, y, n + m), n, m)
                if similar(bound, n + m):
                    out.append((a, b, bound / (n + m - bound)))
            columns = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)],
                names=["a", "b", "bound"],
            )

    x = nodes.select(F.col("node").alias("a"), F.col("n_shingles").alias("n"), F.col("bits").alias("x"))
    y = nodes.select(F.col("node").alias("b"), F.col("n_shingles").alias("m"), F.col("bits").alias("y"))
    both = pairs.join(x, "a").join(y, "b").select("a", "b", "n", "m", "x", "y")
    return both.mapInArrow(run, "a long, b long, bound double")


def sets_by_node(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, tokens of the ``wanted`` nodes, each with the hash of a text that has its set.

    A filter of fixed size, one bit a text hash, keeps most other sets from being made;
    the join afterwards is exact.
    """
    place = F.col("text_hash").bitwiseAND(F.lit(64 * FILTER_WORDS - 1))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
    words = wanted.select(F.shiftright(place, 6).alias("word"), one.alias("bit"))
    # at most FILTER_WORDS rows
    table = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(FILTER_WORDS, np.uint64)
    bits[table["word"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    shared = documents.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = shared.value, set()
        for batch in batches:
            place = batch.column(1).to_numpy().view(np.uint64) % np.uint64(64 * FILTER_WORDS)
            word = (place >> np.uint64(6)).astype(np.int64)
            held = (bits[word] >> (place & np.uint64(63))) & np.uint64(1) > 0
            for block in blocks(batch.column(0).filter(pa.array(held)), lower=True):
                own = Sets(block)
                rows = np.flatnonzero(fresh(own, seen))
                if len(rows):
                    tokens = [own.of(i).tobytes() for i in rows]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own.nodes[rows]), pa.array(tokens, pa.binary())],
                        names=["node", "tokens"],
                    )

    sets = documents.select("text", F.xxhash64("text")).mapInArrow(run, "node long, tokens binary")
    return sets.join(wanted.hint("merge"), "node", "left_semi").dropDuplicates(["node"])


def nodes_of(pairs: DataFrame) -> DataFrame:
    """node: those of the pairs."""
    return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))


def whole_sets(documents: DataFrame, wanted: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, tokens of the wanted nodes, written."""
    wanted = wanted.distinct().join(nodes.select("node", "text_hash"), "node")
    return durable(sets_by_node(documents, durable(wanted, "wanted")), "sets")


def settled_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b: the pairs that are links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                overlap = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(similar(overlap, len(x) + len(y)))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    x = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    both = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")
    return both.mapInArrow(run, "a long, b long")


def links(pairs: DataFrame, documents: DataFrame, nodes: DataFrame) -> DataFrame:
    """a, b: the pairs that are links, by comparing their whole sets."""
    pairs = durable(pairs.select("a", "b"), "pairs")
    return settled_pairs(pairs, whole_sets(documents, nodes_of(pairs), nodes))


def fits(n: str, m: str):
    """The sizes alone leave room for a link."""
    return 100 * F.least(n, m) >= PERCENT * F.greatest(n, m)


def with_roots(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of signatures whose nodes are of several components, with ``root``, the
    component of most rows (``main``), the number of rows (``n``), and the blocks that all
    rows (``blocks``) and those outside ``main`` (``others``) are dealt to."""
    held = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    held = durable(held, "held")
    per_root = held.groupBy("signature", "root").agg(F.count("*").alias("n"), F.sum("size").alias("w"))
    whole = per_root.groupBy("signature").agg(
        F.max(F.struct("n", "root", "w")).alias("largest"),
        F.count("*").alias("roots"),
        F.sum("n").alias("n"),
        F.sum("w").alias("w"),
    )

    def dealt_to(n: Column, w: Column) -> Column:
        return F.greatest(F.ceil(n / BLOCK), F.ceil(w / (BLOCK * TOKENS))).cast("int")

    n, w = F.col("n"), F.col("w")
    mixed = whole.where("roots > 1").select(
        "signature",
        F.col("largest.root").alias("main"),
        "n",
        dealt_to(n, w).alias("blocks"),
        dealt_to(n - F.col("largest.n"), w - F.col("largest.w")).alias("others"),
    )
    return durable(held.join(durable(mixed, "mixed"), "signature"), "rows")


def pairs_of_small(rows: DataFrame) -> DataFrame:
    """a, b: nodes of different components in signatures of few rows."""
    few = rows.where(F.col("n") <= SMALL)
    other = few.select(
        "signature", F.col("node").alias("b"), F.col("size").alias("m"), F.col("root").alias("other")
    )
    both = few.join(other, "signature").where("node < b and root <> other").where(fits("size", "m"))
    return both.select(F.col("node").alias("a"), "b").distinct()


class Shelf:
    """Rows of one bitmap length: their bitmaps as a matrix, and folded to half."""

    def __init__(self, bits: list[bytes], at: np.ndarray):
        self.at = at
        self.whole = np.frombuffer(b"".join(bits), np.uint8).reshape(len(at), -1)
        half = self.whole.shape[1] // 2
        self.half = self.whole[:, :half] ^ self.whole[:, half:]


class Bucket:
    """Rows of one bucket: ``minor`` ones are compared with the other ones."""

    def __init__(self, table: pa.Table):
        columns = ("minor", "node", "size", "root")
        self.minor, self.node, size, self.root = (
            table[c].combine_chunks().to_numpy(zero_copy_only=False) for c in columns
        )
        self.size = size.astype(np.int64)
        self.bits = table["bits"].to_pylist()
        length = np.array([len(x) for x in self.bits])
        rows = np.flatnonzero(~self.minor)
        self.shelves = {
            int(n): Shelf([self.bits[i] for i in rows[length[rows] == n]], rows[length[rows] == n])
            for n in np.unique(length[rows])
        }

    def candidates(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Each minor row, the rows of other components with which its bitmap leaves room
        for a link, and the bounds of their similarity."""
        for i in np.flatnonzero(self.minor).tolist():
            own = np.frombuffer(self.bits[i], np.uint8)
            n, found = len(own), []
            for shelf, theirs, mine in (
                (n, "whole", own),
                (2 * n, "half", own),
                (n // 2, "whole", own[: n // 2] ^ own[n // 2 :]),
            ):
                if shelf not in self.shelves or not len(mine):
                    continue
                at = self.shelves[shelf].at
                apart = np.bitwise_count(getattr(self.shelves[shelf], theirs) ^ mine).sum(axis=1, dtype=np.int64)
                both = self.size[at] + self.size[i]
                bound = np.minimum((both - apart) // 2, np.minimum(self.size[at], self.size[i]))
                keep = (100 * bound >= PERCENT * (both - bound)) & (self.root[at] != self.root[i])
                if keep.any():
                    found.append((at[keep], bound[keep] / (both[keep] - bound[keep])))
            if found:
                yield i, *(np.concatenate(v) for v in zip(*found, strict=True))


def best_of(table: pa.Table) -> pa.Table:
    """r, bound, a, b: the best pair of each component of a bucket's minor rows."""
    bucket, best = Bucket(table), {}
    for i, at, share in bucket.candidates():
        j, r = int(np.argmax(share)), int(bucket.root[i])
        if r not in best or share[j] > best[r][0]:
            best[r] = (share[j], bucket.node[i], bucket.node[at[j]])
    share, a, b = zip(*best.values(), strict=True) if best else ((), (), ())
    kinds = (pa.int64(), pa.float64(), pa.int64(), pa.int64())
    values = [pa.array(v, k) for v, k in zip((list(best), share, a, b), kinds, strict=True)]
    return pa.table(values, names=["r", "bound", "a", "b"])


def asked_of(table: pa.Table) -> pa.Table:
    """bucket, digest, node: the nodes of a bucket that are in a pair that may be a link,
    each once, with a digest of all such pairs."""
    bucket, held, digest = Bucket(table), np.zeros(table.num_rows, bool), np.zeros(1, np.uint64)
    for i, at, _ in bucket.candidates():
        held[at] = held[i] = True
        a, b = (f(bucket.node[at], bucket.node[i]).view(np.uint64) for f in (np.minimum, np.maximum))
        digest += mix(mix(a) + b).sum(dtype=np.uint64)
    node = np.unique(bucket.node[held])
    values = (np.full(len(node), table["bucket"][0].as_py()), np.repeat(digest.view(np.int64), len(node)), node)
    return pa.table([pa.array(v) for v in values], names=["bucket", "digest", "node"])


def forest_of(table: pa.Table) -> pa.Table:
    """a, b: links that join the components of a bucket as far as whole sets do, one link
    less than components are joined."""
    bucket = Bucket(table)
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["tokens"]]
    _, number = np.unique(np.concatenate(sets), return_inverse=True)
    sets = np.split(number, np.cumsum([len(x) for x in sets])[:-1])
    held, label = np.zeros(len(number), bool), bucket.root.copy()
    a, b = [], []
    for i, at, _ in bucket.candidates():
        held[sets[i]] = True
        # in lots of a bounded number of tokens
        cuts = np.flatnonzero(np.diff(np.cumsum(bucket.size[at]) // CHUNK)) + 1
        for lot in np.split(at, cuts):
            lot = lot[label[lot] != label[i]]
            if not len(lot):
                continue
            starts = np.cumsum(bucket.size[lot]) - bucket.size[lot]
            overlap = np.add.reduceat(held[np.concatenate([sets[j] for j in lot])], starts, dtype=np.int64)
            both = bucket.size[lot] + bucket.size[i]
            lot = lot[100 * overlap >= PERCENT * (both - overlap)]
            joined, first = np.unique(label[lot], return_index=True)
            a += [bucket.node[i]] * len(first)
            b += bucket.node[lot[first]].tolist()
            label[np.isin(label, joined)] = label[i]
        held[sets[i]] = False
    return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def bucketed(rows: DataFrame) -> DataFrame:
    """The rows of signatures of many rows, dealt to buckets.

    A signature's rows are dealt out in blocks of about BLOCK, and once more those outside
    its largest component, the minor ones; each two blocks are a bucket.
    """
    many = rows.where(F.col("n") > SMALL)
    columns = ("node", "size", "root", "bits")

    def own(count: str) -> Column:
        return F.pmod(F.xxhash64("node"), count).cast("int")

    def each(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    dealt = many.select("signature", own("blocks").alias("x"), each("others").alias("y"), F.lit(False).alias("minor"), *columns)
    minors = many.where("root <> main").select(
        "signature", each("blocks").alias("x"), own("others").alias("y"), F.lit(True).alias("minor"), *columns
    )
    return dealt.unionByName(minors).select(F.xxhash64("signature", "x", "y").alias("bucket"), "minor", *columns)


def best_pairs(rows: DataFrame) -> DataFrame:
    """a, b: of each component in signatures of many rows the pair with another one that
    is most likely a link. Components that are the largest in all their signatures need none."""
    best = bucketed(rows).groupBy("bucket").applyInArrow(best_of, "r long, bound double, a long, b long")
    best = best.groupBy("r").agg(F.max(F.struct("bound", "a", "b")).alias("best"))
    a, b = F.col("best.a"), F.col("best.b")
    return best.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def asked(rows: DataFrame) -> DataFrame:
    """bucket, node: the nodes that are in pairs that may be links, in signatures of many
    rows. Of buckets with the same pairs, as sets share many signatures, one is asked."""
    found = durable(
        bucketed(rows).groupBy("bucket").applyInArrow(asked_of, "bucket long, digest long, node long"), "asked"
    )
    one = found.groupBy("digest").agg(F.min("bucket").alias("bucket"))
    return durable(found.join(durable(one, "buckets"), ["digest", "bucket"]).select("bucket", "node"), "asked")


def forests(rows: DataFrame, asked: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b: links between the components of the ``asked`` buckets: all that are needed."""
    whole = bucketed(rows).join(asked, ["bucket", "node"]).join(sets, "node")
    return whole.groupBy("bucket").applyInArrow(forest_of, "a long, b long")


def node_components(documents: DataFrame, sets: DataFrame) -> DataFrame:
    """node, root of all nodes with a link."""
    counted = sets.select(
        F.sum(F.col("n_shingles") - F.ceil(F.col("n_shingles") * PERCENT / 100) + 1)
    ).first()[0]
    frequent = Frequent(*frequent_tokens(documents, int(counted or 0)))
    shared = durable(shared_signatures(documents, frequent), "shared")
    nodes = durable(
        sets.where("node is not null").select("node", "n_shingles", "bits", "text_hash").dropDuplicates(["node"]),
        "nodes",
    )

    # 1. each node with the best of its signatures' leaders, another node in each
    lead = F.struct(F.xxhash64("signature", "node").alias("by"), "node", "size")
    leaders = shared.groupBy("signature").agg(F.min(lead).alias("lead"), F.count("*").alias("rows"))
    leaders = durable(
        leaders.where("rows > 1").select(
            "signature", F.col("lead.node").alias("a"), F.col("lead.size").alias("n"), "rows"
        ),
        "leaders",
    )
    joined = durable(shared.join(leaders, "signature"), "joined")
    stars = joined.where(F.col("a") != F.col("node")).where(fits("n", "size"))
    stars = durable(stars.select("a", F.col("node").alias("b")).distinct(), "stars")
    best = possible(stars, nodes).groupBy("b").agg(F.max(F.struct("bound", "a")).alias("best"))
    found = durable(links(best.select(F.col("best.a").alias("a"), "b"), documents, nodes), "first")
    roots = durable(components(found), "roots")

    # 2. in signatures of many rows, the best pair of each component
    few = joined.where(F.col("rows") <= SMALL).select("signature", "node", "size")
    many = joined.where(F.col("rows") > SMALL).select("signature", "node", "size")
    many = durable(many.join(nodes.select("node", "bits"), "node"), "many")
    for _ in range(ROUNDS):
        pairs = durable(best_pairs(with_roots(many, roots)), "best")
        if pairs.isEmpty():
            break
        roots = durable(extended(roots, links(pairs, documents, nodes)), "roots")

    # 3. whatever is left between components
    cross = durable(pairs_of_small(with_roots(few, roots)), "cross")
    pairs = durable(possible(cross, nodes).select("a", "b"), "pairs")
    rows = with_roots(many, roots)
    held = asked(rows)
    sets = whole_sets(documents, nodes_of(pairs).unionByName(held.select("node")), nodes)
    return extended(roots, settled_pairs(pairs, sets).unionByName(forests(rows, held, sets)))


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    sets = durable(sets_of(documents), "sets")
    roots = durable(node_components(documents, sets), "components")
    least = sets.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    named = least.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    named = durable(named, "named")
    ids = durable(named.groupBy("root").agg(F.min("least").alias("component_id")), "ids")
    by_node = durable(named.join(ids, "root").select("node", "component_id"), "by_node")
    full = sets.where("node is not null").select("doc_id", "n_shingles", "node").join(by_node, "node")
    empty = sets.where("node is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return full.select("doc_id", "n_shingles", "component_id").unionByName(empty)
