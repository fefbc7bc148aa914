"""Audit and repair of conversations by a dynamic program over persistent edit scripts.

The cheapest edits that turn a conversation into ``(system? (user assistant)+)?`` are
found in one pass over its rows. The states are what may follow: 0 anything, 1 a user (a
system row stands first), 2 an assistant, 3 a user, or the end. Each state keeps its best
script as a node of ``Prefixes``; equal costs are decided by the scripts' order. Inserts
stand before the row they precede, or at the end, so of two scripts for the same rows
none begins the other, and the better prefix of a state stays the better one.

That also makes the program a product of small matrices: a run of rows has a cost for
each pair of states, and among the scripts that leave one state an order. So a
conversation of any length is cut into chunks, which are solved apart; what is combined
is 16 costs and 16 ranks a chunk, first by partition, then by conversation; the chosen
states go back down and each chunk writes its part of the script.

Rows are dealt by ranges of (conversation, turn, role, text), so a conversation that
holds a third of all rows spreads over many tasks. Those that end where a task ends take
the way over chunks; all others are finished in their task. Equal rows are counted
before they are dealt.

SHA-256 reads its text in order, so the last step streams the repaired texts of a
conversation through one task, in pieces of up to a thousand rows; it holds one piece.

Edge cases: null conversation, role or text: a conversation named null; role and text
read as one blank. Null turns come first and count in no gap. Rows of one turn: by role,
then by text (UTF-8 order). Equal rows are duplicates of the first. Roles are judged by
their initial, which an empty role lacks. Very long texts are hashed as a whole. An
empty table gives an empty one. Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.inputs import arrow_schema
from lotwise.llm.prefixes import Prefixes
from lotwise.session import durable

KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3
TRUNCATED = 3
ROWS_PER_CHUNK, BYTES_PER_CHUNK = 1024, 1 << 20
MOST_KEPT = 100_000
STATES = range(4)
BLANKS = " \t\n\x0b\x0c\r"

# A row as a code: the class of its initial (s, u, a, other) times three, plus its fault.
SOUND, CUT_OFF, FORCED = 0, 1, 2
CLASS = {"s": 0, "u": 1, "a": 2}
# state before: (state after, class that must stand there)
NEXT = {0: ((1, 0), (2, 1)), 1: ((2, 1),), 2: ((3, 2),), 3: ((2, 1),)}
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}

RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired_sha256 string"
)
CHUNK = "part int, chunk int, turns array<long>, roles array<string>, texts array<string>, copies array<long>"


# --- the program over one run of rows ------------------------------------------------


def better(trie: Prefixes, best: list, state: int, cost: int, parent: int, letter: int) -> None:
    """Let a script compete for ``state``."""
    held = best[state]
    if held is not None and held[0] < cost:
        return
    node = trie.push(parent, letter)
    if held is None or cost < held[0] or trie.less(node, held[1]):
        best[state] = (cost, node)


def inserted(trie: Prefixes, best: list) -> list:
    """``best`` after any inserts (more than two in a row are never cheapest)."""
    out = list(best)
    for state in (0, 1, 3):
        if best[state] is not None:
            better(trie, out, 2, best[state][0] + INSERT, best[state][1], ord("I"))
    if out[2] is not None:
        better(trie, out, 3, out[2][0] + INSERT, out[2][1], ord("I"))
    return out


def advance(trie: Prefixes, best: list, code: int) -> list:
    """``best`` after one more row."""
    kind, fault = divmod(code, 3)
    best, out = inserted(trie, best), [None] * 4
    for state in STATES:
        if best[state] is None:
            continue
        cost, node = best[state]
        better(trie, out, state, cost + DELETE, node, ord("D"))
        if fault == FORCED:
            continue
        more = TRUNCATED if fault == CUT_OFF else 0
        for after, wanted in NEXT[state]:
            if kind == wanted:
                better(trie, out, after, cost + KEEP + more, node, ord("K"))
            elif wanted:  # a row is never made a system row
                better(trie, out, after, cost + REROLE + more, node, ord("R"))
    return out


def solved(codes: bytes, start: int) -> tuple[Prefixes, list]:
    trie, best = Prefixes(), [None] * 4
    best[start] = (0, 0)
    for code in codes:
        best = advance(trie, best, code)
    return trie, best


def script(codes: bytes, start: int, end: int) -> str:
    """The best script from ``start`` to ``end``."""
    trie, best = solved(codes, start)
    return bytes(trie.letters(best[end][1])).decode()


def last_step(best: list) -> list[tuple[int, int, str]]:
    """Cost, state and inserts of the cheapest ends of a conversation."""
    options = [(best[s][0] + INSERT * n, s, "I" * n) for s, n in ((0, 0), (3, 0), (2, 1), (1, 2)) if best[s]]
    least = min(cost for cost, _, _ in options)
    return [x for x in options if x[0] == least]


def ended(trie: Prefixes, best: list) -> tuple[int, int, str]:
    """The first of the cheapest ends, by the order of the scripts (those that end in
    different states part before their last row)."""
    options = last_step(best)
    first = options[0]
    for other in options[1:]:
        if trie.less(best[other[1]][1], best[first[1]][1]):
            first = other
    return first


def summary(codes: bytes) -> tuple[list[int], list[int]]:
    """Cost of each pair of states (-1: none), and the order of the scripts of one start."""
    costs, ranks = [], []
    for start in STATES:
        trie, best = solved(codes, start)
        costs += [-1 if b is None else b[0] for b in best]
        ranks += ordered(trie, best)
    return costs, ranks


def ordered(trie: Prefixes, best: list) -> list[int]:
    nodes = [b and b[1] for b in best]
    return [
        0 if n is None else sum(m is not None and m != n and trie.less(m, n) for m in nodes) for n in nodes
    ]


# --- the program over summaries of runs ----------------------------------------------


def folded(costs: np.ndarray, ranks: np.ndarray, start: int) -> tuple[Prefixes, list]:
    """Best way through runs in order. A letter is rank and state of the step, so that
    ways compare at the first run in which they part."""
    trie, best = Prefixes(), [None] * 4
    best[start] = (0, 0)
    for run_costs, run_ranks in zip(costs, ranks, strict=True):
        out = [None] * 4
        for s in STATES:
            if best[s] is None:
                continue
            for t in STATES:
                step = int(run_costs[4 * s + t])
                if step >= 0:
                    better(trie, out, t, best[s][0] + step, best[s][1], 4 * int(run_ranks[4 * s + t]) + t)
        best = out
    return trie, best


def product(costs: np.ndarray, ranks: np.ndarray) -> tuple[list[int], list[int]]:
    """The summary of runs in order."""
    all_costs, all_ranks = [], []
    for start in STATES:
        trie, best = folded(costs, ranks, start)
        all_costs += [-1 if b is None else b[0] for b in best]
        all_ranks += ordered(trie, best)
    return all_costs, all_ranks


def steps(costs: np.ndarray, ranks: np.ndarray, start: int, end: int) -> list[tuple[int, int]]:
    """State before and after each run on the best way from ``start`` to ``end``."""
    trie, best = folded(costs, ranks, start)
    after = [letter % 4 for letter in trie.letters(best[end][1])]
    return list(zip([start, *after], after, strict=False))


# --- rows ----------------------------------------------------------------------------


def fault_of(text: str) -> int:
    bare = text.rstrip(BLANKS)
    return FORCED if not bare else SOUND if bare[-1] in ".!?" else CUT_OFF


def repaired(letters: str, roles: list[str], texts: list[str], start: int) -> Iterator[str]:
    """The ``role:text`` of what a script makes of the rows."""
    state, at = start, 0
    for letter in letters:
        role = "assistant" if state == 2 else "user"
        if letter == "I":
            yield f"{role}:"
        else:
            if letter == "K":
                role = roles[at]
            if letter != "D":
                yield f"{role}:{texts[at]}"
            at += 1
        if letter != "D":
            state = 1 if letter == "K" and role[:1] == "s" and state == 0 else 3 if state == 2 else 2


class Scripts:
    """Cost and script of a whole conversation by its codes; kept, as codes repeat."""

    def __init__(self):
        self.known: dict[bytes, tuple[int, str]] = {}

    def __call__(self, codes: bytes) -> tuple[int, str]:
        found = self.known.get(codes)
        if found is None:
            found = self.computed(codes)
            if len(self.known) >= MOST_KEPT:
                self.known.clear()
            if len(codes) <= 64:
                self.known[codes] = found
        return found

    def computed(self, codes: bytes) -> tuple[int, str]:
        runs = [codes[i : i + ROWS_PER_CHUNK] for i in range(0, len(codes), ROWS_PER_CHUNK)]
        if len(runs) <= 1:
            trie, best = solved(codes, 0)
            cost, state, tail = ended(trie, best)
            return cost, bytes(trie.letters(best[state][1])).decode() + tail
        costs, ranks = (np.array(x) for x in zip(*map(summary, runs), strict=True))
        trie, best = folded(costs, ranks, 0)
        cost, state, tail = ended(trie, best)
        way = steps(costs, ranks, 0, state)
        return cost, "".join(script(r, s, t) for r, (s, t) in zip(runs, way, strict=True)) + tail


class Tally:
    """Faults of rows in order, as counts and codes."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.codes = bytearray()
        self.turns = 0
        self.first_turn = self.last_turn = None
        self.first = self.last = None  # initials

    def add(self, turn, role: str, text: str, copies: int, seen: bool) -> None:
        initial, fault = role[:1], fault_of(text)
        if fault == FORCED:
            self.blank += copies
        else:
            self.duplicate += copies - (not seen)
            self.truncated += fault == CUT_OFF and not seen
            fault = FORCED if seen else fault
        code = 3 * CLASS.get(initial, 3)
        self.codes.append(code + fault)
        self.codes += bytes([code + FORCED]) * (copies - 1)
        if self.first is None:
            self.first = initial
        else:
            self.illegal += (self.last, initial) not in LEGAL
        self.illegal += copies - 1  # no role may follow itself
        self.last = initial
        if turn is not None:
            self.turns += turn != self.last_turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn

    def gaps(self) -> int:
        return 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns


def finished(conv, rows: list[tuple], scripts: Scripts) -> tuple:
    """The result row of a conversation that is held whole."""
    tally, seen, roles, texts = Tally(), set(), [], []
    for turn, role, text, copies in rows:
        key = (role, hashlib.blake2b(text.encode(), digest_size=16).digest())
        tally.add(turn, role, text, copies, key in seen)
        seen.add(key)
        roles += [role] * copies
        texts += [text] * copies
    cost, audit = scripts(bytes(tally.codes))
    whole = "\n".join(repaired(audit, roles, texts, 0))
    return (
        conv, tally.gaps(), tally.blank, tally.duplicate, tally.truncated, tally.illegal,
        cost, audit, hashlib.sha256(whole.encode()).hexdigest(),
    )


def in_partitions(schema: pa.Schema):
    """Finishes conversations inside a sorted partition; packs those at its ends, which
    may go on in the next one, into chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, scripts = TaskContext.get().partitionId(), Scripts()
        out: list[tuple] = []
        chunk = 0
        empty = (None,) * 8

        def packed(conv, rows):
            nonlocal chunk
            cells = [list(x) for x in zip(*rows, strict=True)] or [[], [], [], []]
            out.append((conv, *empty, part, chunk, *cells))
            chunk += 1

        def flushed():
            columns = list(zip(*out, strict=True))
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

        first, started, current, rows, size, held = True, False, None, [], 0, 0
        for batch in batches:
            for conv, turn, role, text, copies, gone in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if started and conv != current:
                    if first:
                        packed(current, rows)
                    else:
                        out.append((*finished(current, rows, scripts), *(None,) * 6))
                    held += size
                    first, rows, size = False, [], 0
                started, current = True, conv
                if gone:
                    continue
                if first and (len(rows) >= ROWS_PER_CHUNK or size >= BYTES_PER_CHUNK):
                    packed(current, rows)
                    held, rows, size = held + size, [], 0
                rows.append((turn, role, text, copies))
                size += len(text)
                if len(out) >= 1000 or held >= 8 << 20:
                    if out:
                        yield flushed()
                    held = 0
        if started:
            begin, size = 0, 0
            for i, row in enumerate(rows):
                if i - begin >= ROWS_PER_CHUNK or (size >= BYTES_PER_CHUNK):
                    packed(current, rows[begin:i])
                    begin, size = i, 0
                size += len(row[2])
            packed(current, rows[begin:])
        if out:
            yield flushed()

    return run


def read_over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks with the places of first occurrences to counts, codes and summary."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            tally, new = Tally(), set(row["firsts"] or [])
            for i, cells in enumerate(zip(row["turns"], row["roles"], row["texts"], row["copies"], strict=True)):
                tally.add(*cells, i not in new)
            costs, ranks = summary(bytes(tally.codes))
            out.append(
                {
                    "conv_id": row["conv_id"], "part": row["part"], "chunk": row["chunk"],
                    "blank": tally.blank, "duplicate": tally.duplicate, "truncated": tally.truncated,
                    "illegal": tally.illegal, "turns": tally.turns, "first_turn": tally.first_turn,
                    "last_turn": tally.last_turn, "first": tally.first, "last": tally.last,
                    "codes": bytes(tally.codes), "costs": costs, "ranks": ranks,
                }
            )
        yield pa.RecordBatch.from_pylist(out, schema=arrow_schema(READ))


READ = (
    "conv_id long, part int, chunk int, blank long, duplicate long, truncated long, illegal long, "
    "turns long, first_turn long, last_turn long, first string, last string, codes binary, "
    "costs array<long>, ranks array<int>"
)
COUNTS = ["blank", "duplicate", "truncated", "illegal", "turns"]
OF_PART = (
    "conv_id long, part int, blank long, duplicate long, truncated long, illegal long, turns long, "
    "first_turn long, last_turn long, first string, last string, costs array<long>, ranks array<int>"
)
CHOSEN = "conv_id long, part int, before int, after int, tail string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
WAY = "part int, chunk int, before int, after int"


def joined_counts(rows: pd.DataFrame) -> dict:
    """Counts of neighbouring runs as those of one run."""
    out = {c: int(rows[c].sum()) for c in COUNTS}
    first_turn = last_turn = first = last = None
    for r in rows.itertuples():
        if isinstance(r.first, str):
            if last is not None:
                out["illegal"] += (last, r.first) not in LEGAL
            first, last = r.first if first is None else first, r.last
        if not pd.isna(r.first_turn):
            out["turns"] -= r.first_turn == last_turn
            first_turn = int(r.first_turn) if first_turn is None else first_turn
            last_turn = int(r.last_turn)
    return out | {"first_turn": first_turn, "last_turn": last_turn, "first": first, "last": last}


def matrices(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return np.stack(rows.costs), np.stack(rows.ranks)


def one_part(rows: pd.DataFrame) -> pd.DataFrame:
    """Chunks of one conversation in one partition: as many as a partition holds."""
    rows = rows.sort_values("chunk")
    costs, ranks = product(*matrices(rows))
    head = {"conv_id": rows.conv_id.iloc[0], "part": rows.part.iloc[0]}
    out = pd.DataFrame([head | joined_counts(rows) | {"costs": costs, "ranks": ranks}])
    return out.astype({"first_turn": "Int64", "last_turn": "Int64", "conv_id": "Int64"})


def one_conversation(rows: pd.DataFrame) -> pd.DataFrame:
    """Parts of one conversation: at most one for each partition."""
    rows = rows.sort_values("part")
    costs, ranks = matrices(rows)
    trie, best = folded(costs, ranks, 0)
    cost, state, tail = ended(trie, best)
    counts = joined_counts(rows)
    first, last = counts["first_turn"], counts["last_turn"]
    gaps = 0 if first is None else last - first + 1 - counts["turns"]
    way = steps(costs, ranks, 0, state)
    out = pd.DataFrame(
        {"conv_id": rows.conv_id.values, "part": rows.part.values, "before": [s for s, _ in way],
         "after": [t for _, t in way], "tail": "", "gaps": gaps, "cost": cost}
        | {c: counts[c] for c in COUNTS if c != "turns"}
    )
    out.iloc[-1, out.columns.get_loc("tail")] = tail
    return out.astype({"conv_id": "Int64"})[[c.split()[0] for c in CHOSEN.split(", ")]]


def in_part(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("chunk")
    way = steps(*matrices(rows), int(rows.before.iloc[0]), int(rows.after.iloc[0]))
    return pd.DataFrame(
        {"part": rows.part.values, "chunk": rows.chunk.values, "before": [s for s, _ in way], "after": [t for _, t in way]}
    )


def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks on their way to script and repaired text."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            letters = script(row["codes"], row["before"], row["after"])
            copies = row["copies"]
            roles = [r for r, n in zip(row["roles"], copies, strict=True) for _ in range(n)]
            texts = [t for t, n in zip(row["texts"], copies, strict=True) for _ in range(n)]
            lines = list(repaired(letters, roles, texts, row["before"]))
            out.append(
                {"conv_id": row["conv_id"], "part": row["part"], "chunk": row["chunk"], "letters": letters,
                 "lines": len(lines), "text": "\n".join(lines)}
            )
        yield pa.RecordBatch.from_pylist(out, schema=arrow_schema(WRITTEN))


WRITTEN = "conv_id long, part int, chunk int, letters string, lines long, text string"
HASHED = "conv_id long, audit string, repaired_sha256 string"


def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to one script and hash a conversation, holding one piece."""
    started, current = False, None
    letters, digest, any_line, before = [], hashlib.sha256(), False, 0

    def row():
        last = {"": "", "I": "assistant:", "II": "user:\nassistant:"}[tail]
        if last:
            digest.update((("\n" if any_line else "") + last).encode())
        return {"conv_id": current, "audit": "".join(letters) + tail, "repaired_sha256": digest.hexdigest()}

    tail, out = "", []
    for batch in batches:
        for piece in batch.to_pylist():
            if started and piece["conv_id"] != current:
                out.append(row())
                letters, digest, any_line = [], hashlib.sha256(), False
            started, current, tail = True, piece["conv_id"], piece["tail"]
            letters.append(piece["letters"])
            if piece["lines"]:
                digest.update((("\n" if any_line else "") + piece["text"]).encode())
                any_line = True
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow_schema(HASHED))
            out = []
    if started:
        yield pa.RecordBatch.from_pylist([row()], schema=arrow_schema(HASHED))


def over_chunks(segments: DataFrame) -> DataFrame:
    """Results of the conversations that are cut into chunks."""
    places = segments.select(
        "conv_id", "part", "chunk", F.posexplode(F.arrays_zip("roles", "texts"))
    ).select("conv_id", "part", "chunk", F.col("pos").alias("at"), "col.roles", F.md5("col.texts").alias("print"))
    firsts = (
        places.groupBy("conv_id", "roles", "print")
        .agg(F.min(F.struct("part", "chunk", "at")).alias("first"))
        .groupBy("first.part", "first.chunk")
        .agg(F.collect_list("first.at").alias("firsts"))  # at most the rows of a chunk
    )
    with_firsts = segments.join(firsts.hint("merge"), ["part", "chunk"], "left")
    chunks = durable(with_firsts.mapInArrow(read_over, READ), "chunks")
    parts = durable(chunks.groupBy("conv_id", "part").applyInPandas(one_part, OF_PART), "parts")
    chosen = durable(parts.groupBy("conv_id").applyInPandas(one_conversation, CHOSEN), "chosen")
    # a partition holds at most two such conversations, each with chunks of its own
    to_steps = chunks.join(
        chosen.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), "before", "after"),
        F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")),
    ).select("conv_id", "part", "chunk", "before", "after", "costs", "ranks")
    way = to_steps.groupBy("conv_id", "part").applyInPandas(in_part, WAY)
    pieces = (
        segments.select("conv_id", "part", "chunk", "roles", "texts", "copies")
        .join(chunks.select("part", "chunk", "codes").hint("merge"), ["part", "chunk"])
        .join(way, ["part", "chunk"])
        .mapInArrow(written, WRITTEN)
    )
    of_conv = chosen.groupBy("conv_id").agg(F.max_by("tail", "part").alias("tail"))
    tails = of_conv.withColumnRenamed("conv_id", "_conv")
    pieces = pieces.join(tails, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    hashes = (
        pieces.repartition("conv_id")
        .sortWithinPartitions("conv_id", "part", "chunk")
        .mapInArrow(hashed, HASHED)
        .withColumnRenamed("conv_id", "_conv")
    )
    numbers = chosen.dropDuplicates(["conv_id"]).drop("part", "before", "after", "tail")
    return numbers.join(hashes, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")


def audited(rows: DataFrame, gone: Column | None = None) -> DataFrame:
    """One row per conversation: gaps, faults, cost, audit and hash of the repaired text.

    ``gone`` marks rows that only name their conversation.
    """
    named = rows.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text"), F.lit(" ")).alias("text"),
        (F.lit(False) if gone is None else F.coalesce(gone, F.lit(False))).alias("gone"),
    )
    counted = named.groupBy("conv_id", "turn", "role", "text", "gone").agg(F.count(F.lit(1)).alias("copies"))
    # the range's borders are sampled rows, so texts stand there with their beginning
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role"]
    dealt = counted.repartitionByRange(*order, F.substring("text", 1, 32)).sortWithinPartitions(*order, "text")
    dealt = dealt.select("conv_id", "turn", "role", "text", "copies", "gone")
    schema = f"{RESULT}, {CHUNK}"
    found = durable(dealt.mapInArrow(in_partitions(arrow_schema(schema)), schema), "conversations")
    columns = [c.split()[0] for c in RESULT.split(", ")]
    whole = found.where("part is null").select(*columns)
    return whole.unionByName(over_chunks(found.where("part is not null")).select(*columns))


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with planted faults, known by the hash of conversation and turn; rows
    that are dropped stay as ``gone`` ones, without text."""
    blank = F.lit(" ")
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank)
    )
    text = F.coalesce(F.col("text"), blank)
    rows = conversations.select(
        "conv_id", "turn", F.coalesce(F.col("role"), blank).alias("role"), text.alias("text"), F.pmod(F.crc32(key), F.lit(20)).alias("kind")
    )
    kind = F.col("kind")
    changed = rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").when(kind == 0, "").otherwise(F.col("role")).alias("role"),
        F.when(kind.isin(0, 1), "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (kind == 0).alias("gone"),
        F.when(kind == 3, 2).otherwise(1).alias("times"),
    )
    return changed.withColumn("_copy", F.explode(F.sequence(F.lit(1), "times"))).drop("times", "_copy")


def report(conversations: DataFrame) -> DataFrame:
    return audited(damaged(conversations), F.col("gone"))
