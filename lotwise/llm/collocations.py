"""Phrases whose words stand together more often than apart, by weighted automata.

Each task counts the n-grams (one to three words, within pieces) of some megabytes of
text into an automaton whose arcs carry counts, and cuts it by range. A range is known by
the hash of an n-gram's first two words; the third adds one of ``FAN`` offsets, so that a
pair which stands everywhere does not meet in one task. Per range the automata are united
and their weights summed; n-grams seen less than ``LEAST`` times go, as no phrase or part
of a phrase can be among them.

For the parts of its phrases a range asks the ranges that count them: the parts it needs
from each, every one once, are an automaton, too, which is composed with the counts there;
the weights go back in the order of its paths. So a frequent word is asked for once by
each range, not once for each phrase, and no word is hot.

Scores are whole numbers of any size. A longer phrase marks the parts that it absorbs;
marked phrases are taken out by a join. The first ``MOST`` of each language are found in
the tasks first.

Edge cases: null text: none; null language: ``und``; repeated rows count as often as they
stand; of equal scores and counts the phrase least in UTF-8 order is first; a very long
text is one shard; an empty table gives an empty one; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotwise.llm.automata import DEPTH, Counts, bundled, hashes, sorted_names, unbundled
from lotwise.llm.words import Block, K, mix
from lotwise.session import durable

LEAST = 10
ABSORBED = 50
MOST = 2000
SCALE = 1_000_000
FAN = 16
SHARD_BYTES = 4 << 20
# n-grams that wait to be united with a range's automaton
WAITING = 300_000
RANGES_PER_PARTITION = 4

# Bytes that end a piece, and bytes of words.
SPLITS = np.zeros(256, bool)
SPLITS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
OF_WORDS = ~SPLITS
OF_WORDS[[0x20, 0x09]] = False


# --- shards --------------------------------------------------------------------------


def counted(langs: pa.Array, texts: pa.Array) -> Counts:
    """The automaton of all n-grams of some texts."""
    langs = pc.fill_null(langs.cast(pa.large_binary()), b"und")
    tags, tag_of_text = sorted_names(langs)
    block = Block(texts, 0, lower=True)
    block.words(OF_WORDS)
    data = block.bytes[: block.size]
    ends = np.concatenate([[0], np.cumsum(block.ends - block.starts)])
    buffers = [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[OF_WORDS[data]].tobytes())]
    words, word = sorted_names(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, buffers))
    text = block.text_of_word()
    splits = np.concatenate([[0], np.cumsum(SPLITS[data])])
    piece = splits[block.starts] + text
    tag = tag_of_text[text]
    # level by level: a node's key is its parent's number and its last word
    at = np.arange(len(word))
    width, state = max(len(words), 1), tag
    none = np.zeros(len(tags), np.int64)
    levels = [(none, np.arange(len(tags)), none)]
    for size in range(1, DEPTH + 1):
        last = at + size - 1
        whole = last < len(word)
        whole[whole] = piece[at[whole]] == piece[last[whole]]
        at, state = at[whole], state[whole]
        keys, state = np.unique(state * width + word[at + size - 1], return_inverse=True)
        levels.append((*np.divmod(keys, width), np.bincount(state, minlength=len(keys))))
    return Counts(tags, words, levels)


def ranges_of(counts: Counts, columns: list[np.ndarray], ranges: int) -> np.ndarray:
    """The range of each n-gram, the same in every task."""
    tags, words = hashes(counts.tags), hashes(counts.words)
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    prefix = mix(tags[columns[0]] * K + words[columns[1]])
    if len(columns) > 2:
        prefix = mix(prefix * K + words[columns[2]])
    at = prefix % np.uint64(ranges)
    if len(columns) > 3:
        at = (at + words[columns[3]] % np.uint64(FAN)) % np.uint64(ranges)
    return at.astype(np.int64)


def cut(counts: Counts, grams: list[tuple], ranges: int) -> Iterator[tuple[int, Counts]]:
    """The n-grams by range, an automaton each."""
    n_tags = max(len(counts.tags), 1)
    keyed = []
    for columns, weights in grams:
        at = ranges_of(counts, columns, ranges)
        keyed.append(([at * n_tags + columns[0], *columns[1:]], weights))
    tags = pa.nulls(ranges * n_tags, pa.large_binary())  # names are told by place alone
    whole = Counts.built(tags, counts.words, keyed)
    place, tag = np.divmod(whole.levels[0][1], n_tags)
    bounds = [np.searchsorted(place, np.arange(ranges + 1))]
    for parent, _, _ in whole.levels[1:]:
        bounds.append(np.searchsorted(parent, bounds[-1]))
    for r in np.unique(place):
        levels = []
        for depth, (parent, symbol, weight) in enumerate(whole.levels):
            a, b = bounds[depth][r], bounds[depth][r + 1]
            above = parent[a:b] - (bounds[depth - 1][r] if depth else 0)
            levels.append((above, symbol[a:b] if depth else tag[a:b], weight[a:b]))
        yield int(r), Counts(counts.tags, counts.words, levels).trimmed()


SHARD = "range int, body binary"


def to_shards(ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, texts in gathered(batches):
            counts = counted(langs, texts)
            yield from rows(cut(counts, counts.grams(), ranges))

    return run


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Languages and texts of whole batches, until they reach a shard's size."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(1).nbytes
        if size >= SHARD_BYTES:
            yield joined(held)
            held, size = [], 0
    if held:
        yield joined(held)


def joined(held: list[pa.RecordBatch]) -> tuple[pa.Array, pa.Array]:
    large = [[b.column(i).cast(pa.large_string()) for b in held] for i in range(2)]
    return tuple(pa.concat_arrays(x) for x in large)


def rows(parts: Iterator[tuple[int, Counts]]) -> Iterator[pa.RecordBatch]:
    out, size = [], 0
    for r, counts in parts:
        out.append((r, counts.packed()))
        size += len(out[-1][1])
        if size >= 4 << 20:
            yield shard_batch(out)
            out, size = [], 0
    if out:
        yield shard_batch(out)


def shard_batch(out: list[tuple[int, bytes]]) -> pa.RecordBatch:
    r, body = zip(*out, strict=True)
    return pa.record_batch({"range": pa.array(r, pa.int32()), "body": pa.array(body, pa.binary())})


# --- ranges --------------------------------------------------------------------------

RANGE = "range int, langs array<binary>, sums array<long>, body binary"


def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards sorted by range to one automaton a range of what is frequent, with the sum
    of all word counts by language."""
    current, running, waiting, size = None, None, [], 0

    def folded():
        return Counts.union([*([running] if running else []), *waiting])

    def finished():
        whole = folded()
        (tag, _), weight = whole.grams()[0]
        sums = np.bincount(tag, weight, len(whole.tags)).astype(np.int64)
        columns = [
            pa.array([current], pa.int32()),
            pa.array([whole.tags.to_pylist()], pa.list_(pa.binary())),
            pa.array([sums.tolist()], pa.list_(pa.int64())),
            pa.array([whole.kept(LEAST).packed()], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["range", "langs", "sums", "body"])

    for batch in batches:
        for r, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if current is not None and r != current:
                yield finished()
                running, waiting, size = None, [], 0
            current = r
            waiting.append(Counts.unpacked(body))
            size += len(waiting[-1].levels[-1][0])
            if size >= max(WAITING, len(running.levels[-1][0]) if running else 0):
                running, waiting, size = folded(), [], 0
    if current is not None:
        yield finished()


# --- parts ---------------------------------------------------------------------------


def candidates(counts: Counts) -> list[tuple[list[np.ndarray], np.ndarray]]:
    return counts.grams(LEAST)[1:]


def parts_asked(counts: Counts) -> list[tuple[list[np.ndarray], np.ndarray]]:
    """First parts and rests of all candidates."""
    (two, _), (three, _) = candidates(counts)
    tag, x, y = two
    t, a, b, c = three
    single = [np.concatenate([tag, tag, t, t]), np.concatenate([x, y, a, c])]
    double = [np.concatenate([t, t]), np.concatenate([a, b]), np.concatenate([b, c])]
    return [(columns, np.ones(len(columns[0]), np.int64)) for columns in (single, double)]


ASK = "range int, asking int, body binary"


def to_asks(ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r, body in zip(batch.column("range").to_pylist(), batch.column("body").to_pylist(), strict=True):
                counts = Counts.unpacked(body)
                asks = [(to, part.packed()) for to, part in cut(counts, parts_asked(counts), ranges)]
                if asks:
                    out = shard_batch(asks)
                    asking = pa.array([r] * len(asks), pa.int32())
                    yield pa.RecordBatch.from_arrays([out.column(0), asking, out.column(1)], names=["range", "asking", "body"])

    return run


def answers(asks: pa.Table, counts: pa.Table) -> pa.Table:
    """The weights of what is asked of one range, in the order of the asking automata."""
    out = []
    if asks.num_rows:
        own = Counts.unpacked(counts.column("body")[0].as_py())
    for body in asks.column("body"):
        part = Counts.unpacked(body.as_py())
        found = own.composed(part)
        out.append(bundled([found[d][part.levels[d][2] > 0] for d in (1, 2)]))
    return pa.table(
        {"range": asks.column("asking"), "asked": asks.column("range"), "weights": pa.array(out, pa.binary())}
    )


SCORED = "lang binary, phrase binary, a long, l long, r long, score long, marked array<binary>"


def to_scores(ranges: int):
    def run(answered: pa.Table, counts: pa.Table) -> pa.Table:
        own = Counts.unpacked(counts.column("body")[0].as_py())
        weights = {
            at: unbundled(body)
            for at, body in zip(answered.column("asked").to_pylist(), answered.column("weights").to_pylist(), strict=True)
        }
        known: dict[tuple, int] = {}
        for at, part in cut(own, parts_asked(own), ranges):
            tags, words = part.tags.to_pylist(), part.words.to_pylist()
            for depth in (1, 2):
                held = part.levels[depth][2] > 0
                named = [c[held].tolist() for c in part.columns(depth)]
                for (tag, *rest), weight in zip(zip(*named, strict=True), weights[at][depth - 1].tolist(), strict=True):
                    known[(tags[tag], *(words[i] for i in rest))] = weight
        tags, words = own.tags.to_pylist(), own.words.to_pylist()
        out = []
        for columns, counts_of in candidates(own):
            for (tag, *rest), a in zip(zip(*(c.tolist() for c in columns), strict=True), counts_of.tolist(), strict=True):
                lang, phrase = tags[tag], [words[i] for i in rest]
                cuts = []
                for k in range(1, len(phrase)):
                    left, right = known[(lang, *phrase[:k])], known[(lang, *phrase[k:])]
                    cuts.append((SCALE * a * a // (left * right), k, left, right))
                score, _, left, right = min(cuts)
                marked = []
                if len(phrase) == 3:
                    marked = [
                        b" ".join(part) for part in (phrase[:2], phrase[1:]) if 100 * a >= ABSORBED * known[(lang, *part)]
                    ]
                out.append((lang, b" ".join(phrase), a, left, right, score, marked))
        kinds = [pa.binary(), pa.binary(), *[pa.int64()] * 4, pa.list_(pa.binary())]
        cells = zip(*out, strict=True) if out else [[]] * len(kinds)
        names = [c.split()[0] for c in SCORED.split(", ")]
        return pa.table({n: pa.array(list(c), k) for n, c, k in zip(names, cells, kinds, strict=True)})

    return run


def collocations(documents: DataFrame, most: int = MOST) -> DataFrame:
    """The first ``most`` phrases of each language."""
    spark = documents.sparkSession
    ranges = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = documents.select("lang", "text").mapInArrow(to_shards(ranges), SHARD)
    by_range = shards.repartition("range").sortWithinPartitions("range")
    counts = durable(by_range.mapInArrow(united, RANGE), "counts")
    bodies = counts.select("range", "body")
    asks = bodies.mapInArrow(to_asks(ranges), ASK)
    answered = asks.groupBy("range").cogroup(bodies.groupBy("range")).applyInArrow(
        answers, "range int, asked int, weights binary"
    )
    scored = answered.groupBy("range").cogroup(bodies.groupBy("range")).applyInArrow(to_scores(ranges), SCORED)
    texts = [F.col(c).cast("string").alias(c) for c in ("lang", "phrase")]
    scored = durable(scored.select(*texts, "a", "l", "r", "score", "marked"), "scored")
    marks = scored.select("lang", F.explode(F.col("marked").cast("array<string>")).alias("phrase")).distinct()
    sums = counts.select(F.explode(F.arrays_zip("langs", "sums")))
    sums = sums.groupBy(F.col("col.langs").cast("string").alias("lang")).agg(F.sum("col.sums").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = (
        scored.join(marks, ["lang", "phrase"], "left_anti")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= most)
    )
    return best.join(sums, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


SQL = f"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\\x0A-\\x0D]')) as piece
  from documents),
worded as (
  select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from pieces),
grams as (
  select lang, 1 as size, unnest(w) as phrase from worded
  union all
  select lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) from worded
  union all
  select lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
  from worded),
f as (
  select lang, size, phrase, count(*)::bigint as n from grams group by all),
candidates as (
  select *, string_split(phrase, ' ') as w from f where size > 1 and n >= {LEAST}),
cuts as (
  select lang, phrase, n as a, k, array_to_string(w[:k], ' ') as head, array_to_string(w[k + 1:], ' ') as rest
  from (select *, unnest(range(1, size)) as k from candidates)),
scored as (
  select c.lang, c.phrase, c.a, k, h.n as l, t.n as r,
    ({SCALE}::hugeint * a * a // (h.n::hugeint * t.n))::bigint as score
  from cuts c join f h on h.lang = c.lang and h.phrase = c.head join f t on t.lang = c.lang and t.phrase = c.rest),
lowest as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
absorbed as (
  select t.lang, p.phrase from candidates t
  join candidates p on p.lang = t.lang and p.size = 2
    and p.phrase in (array_to_string(t.w[:2], ' '), array_to_string(t.w[2:], ' '))
  where t.size = 3 and 100 * t.n >= {ABSORBED} * p.n),
sums as (
  select lang, sum(n)::bigint as n from f where size = 1 group by lang),
ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank
  from lowest anti join absorbed using (lang, phrase))
select lang, rank, phrase, a, l, r, n, score from ranked join sums using (lang) where rank <= {MOST}
"""
