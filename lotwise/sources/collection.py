"""GeoJSON FeatureCollections of any layout, read in as many tasks as Spark splits a file.

Spark's text source splits a file at closing braces. Whether a brace stands in a string,
and how deep it is nested, depends on all that goes before; so a first pass gives each
block's effect on either state (as a block has two sides of a quote to start from), the
effects are summed up in order, one row a block, and a second pass starts every block with
its own state and cuts out the features whole. A feature that goes over the end of a block
is put together from its pieces, a grouping of at most a few of them each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.functions import geometry as G
from lotwise.functions.projection import srid_from_name
from lotwise.schema import SRID_KEY, with_srid
from lotwise.sources.geojson import GEOMETRY, feature_lines

MARKS = re.compile(r'[{}"]|\\.', re.DOTALL)
HEAD_CHARS = 1 << 16
EFFECT = "file string, start bigint, turned boolean, deltas array<int>, lows array<int>, head string"
PIECE = "file string, opener bigint, start bigint, text string"


def _records(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, value): texts between closing braces, by the block that Spark read."""
    text = spark.read.option("lineSep", "}").text(path)
    return text.select("_metadata.file_path", "_metadata.file_block_start", "value")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, str]]:
    for batch in batches:
        for file, start, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield file, start, f"{value}}}"


def effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block: does it turn the side of quotes, how does the nesting change and how low
    does it get, from outside and from inside a string; and a file's beginning."""
    known: dict[tuple, list] = {}
    for file, start, text in _blocks(batches):
        # side, changes and lows from either side, head
        state = known.setdefault((file, start), [0, [0, 0], [0, 0], ""])
        side, deltas, lows = state[0], state[1], state[2]
        if start == 0 and len(state[3]) < HEAD_CHARS:
            state[3] += text[:HEAD_CHARS]
        for mark in MARKS.findall(text):
            if mark == '"':
                side = 1 - side
            elif mark == "{":
                deltas[side] += 1
            elif mark == "}":
                deltas[side] -= 1
                lows[side] = min(lows[side], deltas[side])
        state[0] = side
    names = [c.split()[0] for c in EFFECT.split(", ")]
    rows = [(f, s, v[0] == 1, v[1], v[2], v[3]) for (f, s), v in known.items()]
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.string()]
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)


def starts(blocks: list) -> dict[tuple[str, int], tuple[int, int, int]]:
    """Side of quotes, depth and the block that began the open feature, at each block's start."""
    out, file, side, depth, opener = {}, None, 0, 0, 0
    for b in sorted(blocks, key=lambda b: (b["file"], b["start"])):
        if b["file"] != file:
            file, side, depth, opener = b["file"], 0, 0, b["start"]
        out[(file, b["start"])] = (side, depth, opener)
        low = depth + b["lows"][side]
        if depth < 2 or low < 2:
            opener = b["start"]
        depth += b["deltas"][side]
        side ^= b["turned"]
    return out


def cut(known: dict):
    """Objects two deep, whole or, at a block's ends, in pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, out, size = None, [], [], 0

        def batch_of():
            nonlocal out, size
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
            names = [c.split()[0] for c in PIECE.split(", ")]
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names
            )
            out, size = [], 0
            return batch

        for file, start, text in _blocks(batches):
            if (file, start) != block:
                if parts:
                    out.append((block[0], block[1], block[1], "".join(parts)))
                block, parts = (file, start), []
                side, depth, opener = known[block]
                whole = False  # what is open began here
            at = 0
            for found in MARKS.finditer(text):
                mark = found.group()
                if mark == '"':
                    side = 1 - side
                elif side == 0 and mark == "{":
                    depth += 1
                    if depth == 2:
                        at, whole = found.start(), True
                elif side == 0 and mark == "}":
                    if depth == 2:
                        parts.append(text[at : found.end()])
                        done = "".join(parts)
                        out.append((file, None if whole else opener, start, done))
                        size += len(done)
                        parts, opener = [], start
                    depth -= 1
            if depth >= 2:
                parts.append(text[at:])
            if size >= 4 << 20 or len(out) >= 1000:
                yield batch_of()
        if parts:
            out.append((block[0], block[1] if whole else opener, block[1], "".join(parts)))
        if out:
            yield batch_of()

    return run


def features(spark: SparkSession, path: str) -> tuple[DataFrame, int | None]:
    """(text) of every feature, and the reference system that the collections name."""
    records = _records(spark, path)
    blocks = records.mapInArrow(effects, EFFECT).collect()  # one row a block
    named = {m.group(1) for b in blocks if (m := re.search(r'"crs"\s*:.*?EPSG:+(\d+)', (b["head"] or "").split('"features"')[0], re.DOTALL))}
    if len(named) > 1:
        raise ValueError(f"collections of different reference systems: {sorted(named)}")
    pieces = records.mapInArrow(cut(starts(blocks)), PIECE)
    whole = pieces.where("opener is null").select("text")
    order = F.sort_array(F.collect_list(F.struct("start", "text")))
    joined = pieces.where("opener is not null").groupBy("file", "opener").agg(
        F.array_join(F.transform(order, lambda p: p["text"]), "").alias("text")
    )
    return whole.unionByName(joined.select("text")), srid_from_name(named.pop()) if named else None


def read_collection(spark: SparkSession, path: str, fields: str) -> DataFrame:
    """Rows of FeatureCollection files, their reference system declared where they name
    it. An object that is no JSON raises."""
    texts, srid = features(spark, path)
    schema = f"type string, properties struct<{fields}>, geometry {GEOMETRY}"
    parsed = texts.select(F.from_json("text", schema, {"mode": "FAILFAST"}).alias("f")).where("f.type = 'Feature'")
    g = F.col("f.geometry")
    rows = parsed.select("f.properties.*", G.from_geojson(g["type"], g["coordinates"]).alias("geometry"))
    return rows if srid is None else with_srid(rows, srid)


def write_collection(df: DataFrame, path: str, geometry: str = "geometry", mode: str = "errorifexists") -> None:
    """Each task writes one FeatureCollection that names the column's reference system; the
    folder shows all of them or, if the job fails, none."""
    srid = df.schema[geometry].metadata.get(SRID_KEY)
    crs = f'"crs":{{"type":"name","properties":{{"name":"urn:ogc:def:crs:EPSG::{srid}"}}}},' if srid else ""

    def framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lines():
            yield f'{{"type":"FeatureCollection",{crs}"features":['
            before = None
            for batch in batches:
                for value in batch.column(0).to_pylist():
                    if before is not None:
                        yield before + ","
                    before = value
            if before is not None:
                yield before
            yield "]}"

        held = []
        for line in lines():
            held.append(line)
            if len(held) >= 1000:
                yield pa.record_batch({"value": pa.array(held, pa.string())})
                held = []
        yield pa.record_batch({"value": pa.array(held, pa.string())})

    feature_lines(df, geometry).mapInArrow(framed, "value string").write.mode(mode).text(path)
