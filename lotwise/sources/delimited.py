"""Delimited text with quoted line breaks, read in as many tasks as Spark splits a file.

Spark's text source splits a file at line breaks. Whether one stands in a quoted cell
depends on all that goes before; so a first pass gives the side of quotes that each block
ends on, from either side that it may start on, the effects are chained in order, one row
a block and one group a file, and a second pass, joined to the blocks' sides, starts every
block on its own and joins lines to records.
A record that goes over the end of a block is put together from its pieces.

Quotes count as Spark's CSV reader has them: a cell is quoted if it begins with one, a
doubled one inside stands for itself, and one in an unquoted cell is a character.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.functions.once import with_computed
from lotwise.session import durable

EFFECT = "file string, start bigint, ends array<boolean>, closes boolean, head string"
STATE = "file string, start bigint, block bigint, side boolean, opener bigint, crossed boolean, returning boolean"
PIECE = "opener bigint, start bigint, text string"
TASK_BYTES = 32 << 20
QUOTED = re.compile(r'(?:[^"]|"")*+')
OUTSIDE, INSIDE = False, True


def side_after(line: str, side: bool, sep: str) -> bool:
    """Whether the end of a line stands in a quoted cell, given that its beginning does."""
    if '"' not in line:
        return side
    at = 0
    if side is OUTSIDE and line[0] == '"':
        side, at = INSIDE, 1
    while True:
        if side is INSIDE:
            at = QUOTED.match(line, at).end()
            if at == len(line):
                return INSIDE
        opening = line.find(f'{sep}"', at)
        if opening < 0:
            return OUTSIDE
        side, at = INSIDE, opening + len(sep) + 1


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select("_metadata.file_path", "_metadata.file_block_start", "value")


def _bytes(text: str) -> int:
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", text.lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def _gathered(lines: DataFrame) -> DataFrame:
    """Blocks much smaller than a task is worth share tasks; each stays a block."""
    spark = lines.sparkSession
    at_once = TASK_BYTES // _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    blocks = lines.rdd.getNumPartitions()
    tasks = max(spark.sparkContext.defaultParallelism, -(-blocks // max(at_once, 1)))
    return lines.coalesce(tasks) if tasks < blocks else lines


def _runs(batch: pa.RecordBatch, *by: str) -> Iterator[pa.RecordBatch]:
    """Slices of rows that follow each other and agree in ``by``."""
    new = np.zeros(max(batch.num_rows - 1, 0), bool)
    for c in by:
        held = batch.column(c)
        new |= pc.not_equal(held[1:], held[:-1]).to_numpy(zero_copy_only=False)
    cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
    yield from (batch.slice(i, j - i) for i, j in zip(cuts, cuts[1:], strict=False) if j > i)


def _batch(rows: list[tuple], schema: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), kind) for c, (_, kind) in zip(columns, schema, strict=True)],
        names=[name for name, _ in schema],
    )


def effects(sep: str):
    """Per block: the sides it ends on, from outside and from inside; does it end a record
    that it finds open; a file's first record. Only lines with quotes are walked."""
    schema = [
        ("file", pa.string()), ("start", pa.int64()), ("ends", pa.list_(pa.bool_())),
        ("closes", pa.bool_()), ("head", pa.string()),
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, list] = {}
        for batch in batches:
            for same in _runs(batch, "file_path", "file_block_start"):
                file, start = (same.column(i)[0].as_py() for i in (0, 1))
                block = known.get((file, start))
                if block is None:
                    block = known[(file, start)] = [[OUTSIDE, INSIDE], False, None, [] if start == 0 else None]
                at, lines = 0, same.column("value")
                while block[3] is not None and at < len(lines):
                    walk(block, lines[at].as_py())
                    at += 1
                rest = lines[at:]
                for line in rest.filter(pc.match_substring(rest, '"')).to_pylist():
                    walk(block, line)
        yield _batch([(*key, *block[:3]) for key, block in known.items()], schema)

    def walk(block: list, line: str) -> None:
        ends, closes, _, held = block
        if '"' in line:
            ends = block[0] = [side_after(line, side, sep) for side in ends]
            block[1] = closes or ends[1] is OUTSIDE
        if held is not None and (held or line.rstrip("\r")):
            held.append(line)
            if ends[0] is OUTSIDE:
                block[2:] = "\n".join(held), None

    return run


def starts(blocks: pa.Table) -> pa.Table:
    """Of one file's blocks: the side that each starts on, the block that began the open
    record, does a record go over one of its ends, do the file's lines end in CR LF."""
    out, side, opener, returning = [], OUTSIDE, None, False
    for b in blocks.sort_by("start").to_pylist():
        if b["start"] == 0:
            returning = bool(b["head"]) and b["head"].endswith("\r")
        if opener is None:
            opener = b["block"]
        began, came_from = side, opener
        if side is OUTSIDE or b["closes"]:  # what it leaves open is its own
            opener = b["block"]
        side = b["ends"][side]
        out.append((b["file"], b["start"], b["block"], began, came_from, began or side, returning))
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.bool_()]
    names = [c.split()[0] for c in STATE.split(", ")]
    return pa.Table.from_batches([_batch(out, list(zip(names, kinds, strict=True)))])


def records_of(sep: str):
    """Records, whole or, at a block's ends, in pieces; a file's header is left out.

    Lines of a file that end in CR LF count it as one line break. Lines without a quote
    that stand outside are records as they are.
    """
    schema = [("opener", pa.int64()), ("start", pa.int64()), ("text", pa.string())]

    def plain(lines: pa.Array, returning: bool) -> pa.RecordBatch:
        if returning:
            lines = pc.if_else(pc.ends_with(lines, "\r"), pc.utf8_slice_codeunits(lines, 0, -1), lines)
        lines = lines.filter(pc.not_equal(pc.utf8_rtrim(lines, "\r"), ""))
        none = pa.nulls(len(lines), pa.int64())
        return pa.RecordBatch.from_arrays([none, none, lines], names=[name for name, _ in schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, began, held, out, size = None, None, [], [], 0
        side, opener, header = OUTSIDE, None, False
        for batch in batches:
            for same in _runs(batch, "block"):
                number = same.column("block")[0].as_py()
                if number != block:
                    if held:
                        out.append((block if opener is None else opener, began, "\n".join(held)))
                    block, held, began = number, [], same.column("start")[0].as_py()
                    header, side = began == 0, same.column("side")[0].as_py()
                    # None: the record began here
                    opener = same.column("opener")[0].as_py() if side is INSIDE else None
                    returning = same.column("returning")[0].as_py()
                lines = same.column("value")
                if side is OUTSIDE and not held and not header and not pc.any(pc.match_substring(lines, '"')).as_py():
                    yield plain(lines, returning)
                    continue
                for line in lines.to_pylist():
                    if returning:
                        line = line.removesuffix("\r")
                    held.append(line)
                    side = side_after(line, side, sep)
                    if side is OUTSIDE:
                        text = held[0] if len(held) == 1 else "\n".join(held)
                        blank = opener is None and not text.rstrip("\r")
                        if header and not blank:
                            header = False
                        elif not blank:
                            out.append((opener, began, text))
                            size += len(text)
                        held, opener = [], None
                    if size >= 4 << 20 or len(out) >= 10_000:
                        yield _batch(out, schema)
                        out, size = [], 0
        if held:
            out.append((block if opener is None else opener, began, "\n".join(held)))
        yield _batch(out, schema)

    return run


def cells_of(header: str, sep: str) -> list[str]:
    return next(csv.reader([header.lstrip("\ufeff").rstrip("\r")], delimiter=sep))


def named(cells: list[str]) -> list[str]:
    """Column names as Spark's CSV reader makes them: a nameless cell by its place, one
    of several of a name with its place behind."""
    low = [c.lower() for c in cells]
    return [f"_c{i}" if not c else f"{c}{i}" if low.count(c.lower()) > 1 else c for i, c in enumerate(cells)]


def records(spark: SparkSession, path: str, sep: str) -> tuple[DataFrame, list[str]]:
    """(text) of every record but the headers, and the names that the headers give.

    Files whose headers differ are an error.
    """
    lines = _gathered(_lines(spark, path))
    found = lines.mapInArrow(effects(sep), EFFECT)
    blocks = durable(found.withColumn("block", F.monotonically_increasing_id()), "blocks")  # one row a block
    heads = {b["file"]: b["head"] for b in blocks.where("start = 0").select("file", "head").collect()}
    if any(h is None for h in heads.values()):
        raise ValueError("a header that does not end in its file's first split")
    names = {tuple(cells_of(h.lower(), sep)) for h in heads.values()}
    if len(names) > 1:
        raise ValueError(f"CSV header does not conform: {sorted(names)} in one table")
    state = durable(blocks.groupBy("file").applyInArrow(starts, STATE), "starts")

    def pieces(known: DataFrame) -> DataFrame:
        here = (F.col("file_path") == F.col("file")) & (F.col("file_block_start") == F.col("start"))
        placed = lines.join(F.broadcast(known), here)
        return placed.select("block", "start", "side", "opener", "returning", "value").mapInArrow(records_of(sep), PIECE)

    whole = pieces(state).where("opener is null").select("text")
    order = F.sort_array(F.collect_list(F.struct("start", "text")))
    # blocks that no record goes over the end of are not read for it
    joined = pieces(state.where("crossed")).where("opener is not null").groupBy("opener").agg(
        F.array_join(F.transform(order, lambda p: p["text"]), "\n").alias("text")
    )
    text = F.when(F.col("text").contains("\r"), F.regexp_replace("text", r"\r$", "")).otherwise(F.col("text"))
    first = min(heads, default=None)
    columns = named(cells_of(heads[first], sep)) if heads else []
    return whole.unionByName(joined.select("text")).select(text.alias("text")), columns


def read(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """Rows of the files, all columns as text."""
    texts, names = records(spark, path, sep)
    if not names:
        return spark.createDataFrame([], T.StructType())
    places = ", ".join(f"c{i} string" for i in range(len(names)))  # names may hold any sign
    cells = F.from_csv("text", places, {"sep": sep, "escape": '"', "multiLine": "true"})
    # parsed once a record, whatever filters the columns get
    return with_computed(texts, cells=cells).select("cells.*").toDF(*names)
