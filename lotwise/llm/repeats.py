"""Removal of byte strings that stand twice, by sorting suffixes where it matters.

A suffix matters if its first ``WIDTH`` bytes may stand elsewhere. To find those without
moving every suffix, each window of WIDTH bytes is known by its anchor, the first of its
runs of ``ANCHOR`` bytes with the least hash: equal windows have equal anchors at equal
offsets. Neighbouring windows share an anchor, so a text is a list of pieces (an anchor
and the windows it stands for), one for every sixty bytes or so.

1. Pieces, as hashes of their anchor and of all their bytes, are shuffled by anchor. An
   anchor that stands once clears its piece. Pieces with the same bytes are repeated as a
   whole. Pieces that share an anchor, not all bytes, are left: each different one once.
2. Texts meet their open pieces, which are cut into cells: the windows whose anchor lies
   at much the same offset. They have most of their bytes in common, which makes the key
   of a bucket; so a line that a third of all texts holds does not meet in one task, nor
   do pieces that part near the anchor.
3. Buckets are sorted by deep-shallow sorting; windows equal in all bytes are repeated.
   A crowded bucket goes on, cut into single windows, to be compared in a stream.
4. Texts meet their repeated windows, and lose the bytes these cover.

What is equal is decided by bytes in 3 and by 128-bit hashes of pieces in 1. A task holds
one block of texts or buckets. Pieces that one batch holds twice are settled there, so a
text of which there are many copies arrives once a batch.

Edge cases: null texts read as empty; texts shorter than WIDTH lose nothing; null or
repeated ids are no harm, as a text is known by id and hash together, and rows equal in
both lose the same bytes; a long text is one block; an empty table gives an empty one;
further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.automata import spans
from lotwise.llm.suffixes import deep_shallow
from lotwise.llm.words import Block, K, blocks, mix
from lotwise.session import durable

WIDTH = 200
ANCHOR = 64
CELL = 28
BLOCK_STRINGS = 1 << 17
CROWDED = 1 << 12

WHOLE, OPEN = 0, 1  # a piece repeated as a whole; one that must be compared
PIECE = "key long, d1 long, d2 long, id long, print long, place long, kind int"


# --- pieces --------------------------------------------------------------------------


def anchors(block: Block, width: int = WIDTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Pieces of a block: first window, number of windows, place of the anchor, its hash,
    and the text."""
    sizes = np.diff(block.offsets) - 1  # a blank follows each text
    size, n = block.size, block.size - width + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none
    eights = np.ndarray((size + 1,), np.dtype("<u8"), buffer=block.bytes.data, strides=(1,))
    h, have = mix(eights[:size].copy()), 8
    while have < anchor:
        step = min(have, anchor - have)
        h = mix(h[: len(h) - step] * K + h[step:])
        have += step
    # after the doubling h[i] covers bytes i .. i + anchor - 1
    h = h[: size - anchor + 1]
    least, at, have = h, np.arange(len(h)), 1
    while have < width - anchor + 1:
        step = min(have, width - anchor + 1 - have)
        left, right = least[: len(least) - step], least[step:]
        moved = right < left
        at = np.where(moved, at[step:], at[: len(at) - step])
        least = np.where(moved, right, left)
        have += step
    text = np.repeat(np.arange(block.n), sizes + 1)[:n]
    inside = np.flatnonzero(np.arange(n) + width <= (block.offsets[1:] - 1)[text])
    if not len(inside):
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none
    at, text = at[inside], text[inside]
    # an anchor lies in one text, as its windows do
    begins = np.flatnonzero(np.concatenate([[True], np.diff(at) != 0]))
    counts = np.diff(np.concatenate([begins, [len(at)]]))
    place = at[begins]
    return inside[begins], counts, place, h[place], text[begins]


def packed(start: np.ndarray, count: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """First window, number of windows and the anchor's offset as one number."""
    return (start << 16) | (count << 8) | offset


def unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 16, (place >> 8) & 255, place & 255


def to_pieces(width: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, prints = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for block in blocks(batch.column(2)):
                yield from settled(block, ids[block.first :], prints[block.first :], width, anchor)

    return run


def settled(block: Block, ids, prints, width: int, anchor: int) -> Iterator[pa.RecordBatch]:
    """The pieces of a block; of those it holds twice, one goes on for the others' sake."""
    start, count, at, key, text = anchors(block, width, anchor)
    if not len(start):
        return
    data = block.bytes.tobytes()
    bounds = zip(start.tolist(), (start + count + width - 1).tolist(), strict=True)
    digest = hashlib.blake2b
    raw = b"".join([digest(data[a:b], digest_size=16).digest() for a, b in bounds])
    print_ = np.frombuffer(raw, np.int64).reshape(-1, 2)
    _, first, kind, copies = np.unique(
        np.frombuffer(raw, "V16"), return_index=True, return_inverse=True, return_counts=True
    )
    place = packed(start - block.offsets[text], count, at - start)
    of_id, of_print = ids[text], prints[text]
    twice = np.flatnonzero(copies[kind] > 1)
    # settled here: dealt anywhere
    anywhere = mix((of_print[twice].astype(np.uint64) + place[twice].astype(np.uint64)) * K).astype(np.int64)
    yield pieces(anywhere, print_[twice], of_id[twice], of_print[twice], place[twice], WHOLE)
    yield pieces(
        key[first].astype(np.int64), print_[first], of_id[first], of_print[first], place[first],
        np.where(copies > 1, 2, 1),
    )


def pieces(key, print_, of_id, of_print, place, kind) -> pa.RecordBatch:
    kinds = np.broadcast_to(np.asarray(kind, np.int32), key.shape)
    columns = [key, print_[:, 0], print_[:, 1], of_id, of_print, place, kinds]
    names = [c.split()[0] for c in PIECE.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=names)


FOUND = "id long, print long, place long, kind int, copied boolean"


def told_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by anchor and bytes to those repeated as a whole and those that are
    open; holds one piece of an anchor."""
    out: list[tuple] = []
    key = print_ = first = rep = None
    shared, whole = False, False  # the anchor has other bytes, too; the bytes stand twice

    def end_of_print():
        """The bytes are over: one of them stands for all among the anchor's."""
        nonlocal rep, shared
        if first is None:
            return
        mine = (*first, OPEN, whole)
        if shared:
            out.append(mine)
        elif rep is not None:
            shared = True
            out.extend([rep, mine])
        else:
            rep = mine

    for batch in batches:
        columns = [batch.column(i).to_numpy() for i in range(7)]
        keys, kinds = columns[0], columns[6]
        done = np.flatnonzero(kinds == WHOLE)
        if len(done):
            yield found(*(columns[i][done] for i in (3, 4, 5)), np.zeros(len(done), np.int32), np.ones(len(done), bool))
        live = np.flatnonzero(kinds != WHOLE)
        if not len(live):
            continue
        k = keys[live]
        alone = np.ones(len(k), bool)
        alone[1:] &= k[1:] != k[:-1]
        alone[:-1] &= k[1:] != k[:-1]
        alone[[0, -1]] = False  # their neighbours may be in other batches
        rows = live[~alone]
        for k, a, b, i, p, place, kind in zip(*(c[rows].tolist() for c in columns), strict=True):
            if k != key:
                end_of_print()
                key, print_, first, rep, shared = k, None, None, None, False
            if (a, b) != print_:
                end_of_print()
                print_, first, whole = (a, b), (i, p, place), kind > 1
                continue
            if not whole:
                out.append((*first, WHOLE, True))
            whole = True
            out.append((i, p, place, WHOLE, True))
        if len(out) >= 10_000:
            yield found(*zip(*out, strict=True))
            out = []
    end_of_print()
    if out:
        yield found(*zip(*out, strict=True))


def found(of_id, of_print, place, kind, copied) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_()]
    cells = zip((of_id, of_print, place, kind, copied), kinds, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in cells], names=[c.split()[0] for c in FOUND.split(", ")])


# --- buckets -------------------------------------------------------------------------

BUCKET = "bucket long, id long, print long, start long, data binary, copied boolean"


def bucket_batch(out: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]
    cells = zip(zip(*out, strict=True), kinds, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in cells], names=[c.split()[0] for c in BUCKET.split(", ")])


def number_of(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def to_buckets(width: int, cell: int):
    """Texts with their open pieces to cells: the bytes of the windows whose anchor is at
    offsets ``cell * j`` to ``cell * (j + 1) - 1``, by what such windows have in common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for batch in batches:
            columns = (batch.column(i).to_pylist() for i in range(5))
            for i, p, data, places, copied in zip(*columns, strict=True):
                for place, copy in zip(places, copied, strict=True):
                    start, count, offset = place >> 16, (place >> 8) & 255, place & 255
                    at = start + offset
                    for j in range((offset - count + 1) // cell, offset // cell + 1):
                        a = max(start, at - cell * (j + 1) + 1)
                        b = min(start + count - 1, at - cell * j)
                        common = data[at - cell * j : at - cell * (j + 1) + 1 + width]
                        out.append((number_of(common + bytes([j])), i, p, a, data[a : b + width], copy))
                        size += b - a + width
                if size >= 4 << 20:
                    yield bucket_batch(out)
                    out, size = [], 0
        if out:
            yield bucket_batch(out)

    return run


def to_windows(width: int):
    """Cells to single windows, by all their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, p, start, data, copied in zip(*(batch.column(k).to_pylist() for k in range(1, 6)), strict=True):
                for at in range(len(data) - width + 1):
                    window = data[at : at + width]
                    out.append((number_of(window), i, p, start + at, window, copied))
            if out:
                yield bucket_batch(out)

    return run


SORTED = "id long, print long, start long, count long, data binary, copied boolean"


def sorted_batch(out: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]
    cells = zip(zip(*out, strict=True), kinds, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in cells], names=[c.split()[0] for c in SORTED.split(", ")])


def sort_block(groups: list[list[tuple]], width: int) -> list[tuple]:
    """Runs of windows of whole buckets that are equal to another window there."""
    rows = [row for group in groups for row in group]
    data = b"".join(row[3] for row in rows)
    sizes = np.array([len(row[3]) for row in rows])
    counts = sizes - width + 1
    starts = spans(np.cumsum(sizes) - sizes, counts)
    of_row = np.repeat(np.arange(len(rows)), counts)
    group = np.repeat(np.repeat(np.arange(len(groups)), [len(g) for g in groups]), counts)
    _, number = deep_shallow(data, starts, group, width)
    repeated = np.bincount(number)[number] > 1
    repeated &= ~np.array([row[4] for row in rows])[of_row]  # those are known already
    hit = np.flatnonzero(repeated)
    if not len(hit):
        return []
    breaks = np.flatnonzero(np.concatenate([[True], (np.diff(hit) != 1) | (np.diff(of_row[hit]) != 0)]))
    lengths = np.diff(np.concatenate([breaks, [len(hit)]]))
    first_of = np.cumsum(counts) - counts
    out = []
    for at, length in zip(hit[breaks].tolist(), lengths.tolist(), strict=True):
        row = of_row[at]
        out.append((rows[row][0], rows[row][1], rows[row][2] + int(at - first_of[row]), length, None, None))
    return out


def to_sorted(width: int, crowded: int):
    """Buckets to runs of repeated windows; crowded buckets go on as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, group, groups, strings, over = None, [], [], 0, False
        out: list[tuple] = []

        def closed():
            nonlocal group, strings
            if len(group) > 1 and not over:
                groups.append(group)
                strings += sum(len(r[3]) - width + 1 for r in group)
            group = []

        for batch in batches:
            for bucket, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != current:
                    closed()
                    current, over = bucket, False
                    if strings >= BLOCK_STRINGS:
                        out += sort_block(groups, width)
                        groups, strings = [], 0
                if over:
                    out.append((*row[:3], 0, *row[3:]))
                else:
                    group.append(row)
                    if len(group) > crowded:
                        over = True
                        out += [(*r[:3], 0, *r[3:]) for r in group]
                        group = []
            if len(out) >= 5000:
                yield sorted_batch(out)
                out = []
        closed()
        if groups:
            out += sort_block(groups, width)
        if out:
            yield sorted_batch(out)

    return run


def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Single windows sorted by all their bytes: those equal to a neighbour."""
    before, out = None, []

    def told(row):
        if not row[4]:
            out.append((row[0], row[1], row[2], 1, None, None))

    first_told = False
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(1, 6)), strict=True):
            if before is not None and row[3] == before[3]:
                if not first_told:
                    told(before)
                told(row)
                first_told = True
            else:
                first_told = False
            before = row
        if out:
            yield sorted_batch(out)
            out = []


# --- texts ---------------------------------------------------------------------------

RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def covered(starts: list[int], counts: list[int], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs of bytes that windows cover, as begins and ends."""
    a = np.array(starts, np.int64)
    order = np.argsort(a, kind="stable")
    a, b = a[order], (a + np.array(counts, np.int64) - 1 + width)[order]
    reach = np.maximum.accumulate(b)
    new = np.concatenate([[True], a[1:] > reach[:-1]])
    return a[new], reach[np.concatenate([new[1:], [True]])]


def to_kept(width: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, data, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data, kept, removed, n = data or b"", data or b"", 0, 0
                if places:
                    begins, ends = covered([p["start"] for p in places], [p["count"] for p in places], width)
                    edges = [0, *np.stack([begins, ends], 1).ravel().tolist(), len(data)]
                    kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                    removed, n = len(data) - len(kept), len(begins)
                digest = hashlib.sha256(kept).hexdigest()
                out.append((doc, len(data), removed, n, digest, kept if with_text else None))
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            cells = zip(zip(*out, strict=True), kinds, strict=True) if out else ()
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in cells], names=[c.split()[0] for c in RESULT.split(", ")])

    return run


def known(documents: DataFrame) -> DataFrame:
    """id, print and text of each row; rows equal in the first two are taken as equal."""
    text: Column = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return documents.select(
        F.col("doc_id"), F.coalesce("doc_id", F.lit(-1)).alias("id"), F.xxhash64(text).alias("print"), text.alias("text")
    )


def repeated_windows(documents: DataFrame, width: int = WIDTH, anchor: int = ANCHOR, cell: int = CELL, crowded: int = CROWDED) -> DataFrame:
    """id, print, start, count: runs of windows that stand elsewhere, too."""
    rows = known(documents)
    texts = rows.where(F.octet_length("text") >= width).select("id", "print", F.col("text").cast("binary").alias("text"))
    dealt = texts.mapInArrow(to_pieces(width, anchor), PIECE).repartition("key")
    apart = durable(dealt.sortWithinPartitions("key", "d1", "d2").mapInArrow(told_apart, FOUND), "pieces")
    of_text = (
        apart.where(F.col("kind") == OPEN)
        .groupBy("id", "print")
        .agg(F.collect_set(F.struct("place", "copied")).alias("open"))
    )
    # of rows equal in id and text one is enough: their pieces are known to be copied
    met = texts.join(of_text, ["id", "print"])
    met = met.select("id", "print", "text", "open.place", "open.copied")
    buckets = met.mapInArrow(to_buckets(width, cell), BUCKET).repartition("bucket").sortWithinPartitions("bucket")
    found_runs = durable(buckets.mapInArrow(to_sorted(width, crowded), SORTED), "windows")
    single = found_runs.where("count = 0").select(F.lit(0).cast("long").alias("bucket"), "id", "print", "start", "data", "copied")
    single = single.mapInArrow(to_windows(width), BUCKET).repartition("bucket").sortWithinPartitions("bucket", "data")
    columns = ["id", "print", "start", "count"]
    whole = apart.where(F.col("kind") == WHOLE).select(
        "id", "print", F.shiftright("place", 16).alias("start"), F.shiftright("place", 8).bitwiseAND(F.lit(255).cast("long")).alias("count")
    )
    return (
        whole.unionByName(found_runs.where("count > 0").select(*columns))
        .unionByName(single.mapInArrow(streamed, SORTED).select(*columns))
    )


def removed(documents: DataFrame, width: int = WIDTH, with_text: bool = True, **method) -> DataFrame:
    """Per row: bytes, removed bytes and runs, hash of the rest, and the rest itself."""
    places = repeated_windows(documents, width, **method).groupBy("id", "print")
    places = places.agg(F.collect_set(F.struct("start", "count")).alias("places"))
    rows = known(documents).join(places, ["id", "print"], "left")
    rows = rows.select("doc_id", F.col("text").cast("binary").alias("text"), "places")
    return rows.mapInArrow(to_kept(width, with_text), RESULT)


def report(documents: DataFrame) -> DataFrame:
    return removed(documents, with_text=False).drop("kept")


SQL = f"""
with texts as (
  select row_number() over () as row_no, doc_id, encode(coalesce(text, '')) as data, hex(data) as digits from documents),
windows as (
  select row_no, pos, md5_number(data[pos + 1 : pos + {WIDTH}]) as print
  from (select row_no, data, unnest(range(0, length(digits) // 2 - {WIDTH - 1})) as pos from texts)),
twice as (
  select print from windows group by print having count(*) > 1),
marked as (
  select row_no, pos, case when pos <= lag(pos) over (partition by row_no order by pos) + {WIDTH} then 0 else 1 end as new
  from windows semi join twice using (print)),
numbered as (
  select row_no, pos, sum(new) over (partition by row_no order by pos) as run from marked),
runs as (
  select row_no, run, min(pos) as a, max(pos) + {WIDTH} as b from numbered group by all),
pieces as (
  select row_no, a, b, lag(b, 1, 0) over (partition by row_no order by a) as before from runs),
rests as (
  select row_no, sum(b - a) as n_removed, count(*) as n_spans, max(b) as last,
    string_agg(substring(digits, 2 * before + 1, 2 * (a - before)), '' order by a) as head
  from pieces join texts using (row_no) group by row_no)
select doc_id, length(digits) // 2 as n_bytes, coalesce(n_removed, 0)::bigint as n_removed,
  coalesce(n_spans, 0) as n_spans,
  sha256(unhex(coalesce(head, '') || substring(digits, 2 * coalesce(last, 0) + 1))) as kept_sha256
from texts left join rests using (row_no)
"""
