"""Token ids of documents in files of Simple-8b segments, in ascending id order.

Rows are dealt out by ranges of (doc_id, hash of the text), so that a repeated id cannot
pile up in one task. Each task encodes its range and emits segments: rows with the ids
and lengths of some whole documents and one binary segment. Spark's own writer commits
them, as Parquet files that hold the segments as they are: any store will do, and a lost
executor's files are written again. A document's start is its place in its part plus
the parts before, of which there is one total a part.

Edge cases: null ids come first, equal ids in the order of the hash of their text; a null
or empty text is one end id; an empty table gives no segment; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm import simple8b
from lotwise.llm.tokens import encoder, public_path
from lotwise.session import new_folder

SEGMENT_IDS = 1 << 18
FILES = (
    "part int, segment int, part_start long, doc_ids array<long>, lengths array<long>, "
    "n_ids long, payload binary"
)
BACK = "part int, doc_id long, in_part long, n_tokens long, ids_crc32 long"


def write(documents: DataFrame, folder: str, path: str | None = None) -> None:
    """Encode every text, END appended, and write the segments to ``folder``."""
    path = path or public_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        part, segment, start = TaskContext.get().partitionId(), 0, 0
        doc_ids: list[int | None] = []
        pieces: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            ids = np.concatenate(pieces)
            row = [part, segment, start, list(doc_ids), [len(x) for x in pieces], len(ids)]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([x], kind)
                    for x, kind in zip(
                        [*row, simple8b.encode(ids)],
                        [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
                        + [pa.list_(pa.int64()), pa.int64(), pa.binary()],
                        strict=True,
                    )
                ],
                names=[c.split()[0] for c in FILES.split(", ")],
            )

        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), code.each(batch.column(1)), strict=True):
                pieces.append(ids)
                doc_ids.append(doc_id)
                size += len(ids)
                if size >= SEGMENT_IDS:
                    yield flush()
                    segment, start, size = segment + 1, start + size, 0
                    pieces.clear()
                    doc_ids.clear()
        if pieces:
            yield flush()

    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie")
    )
    dealt = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    dealt.select("doc_id", "text").mapInArrow(run, FILES).write.parquet(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone."""
    files = spark.read.schema(FILES).parquet(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = simple8b.decode(row["payload"]).astype("<u4")
                if len(ids) != row["n_ids"]:
                    raise ValueError(f"segment {row['part']}/{row['segment']} is cut off")
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                starts = ends - lengths
                crc = [
                    zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(lengths), row["part"], np.int32)),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(row["part_start"] + starts),
                        pa.array(lengths),
                        pa.array(crc, pa.int64()),
                    ],
                    names=[c.split()[0] for c in BACK.split(", ")],
                )

    # one total a part: as many as tasks wrote, whatever the documents' number
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("ids")).orderBy("part").collect()
    sums = np.cumsum([0, *(r["ids"] for r in totals)])
    before = spark.createDataFrame(
        [(r["part"], int(s)) for r, s in zip(totals, sums, strict=False)], "part int, base long"
    )
    documents = files.mapInArrow(run, BACK).join(F.broadcast(before), "part")
    return documents.select(
        "doc_id", (F.col("base") + F.col("in_part")).alias("start"), "n_tokens", "ids_crc32"
    )


def round_trip(documents: DataFrame, path: str | None = None) -> DataFrame:
    """Write the files to the shared folder and read them back."""
    spark = documents.sparkSession
    folder = new_folder(spark, "tokens")
    write(documents, folder, path)
    return read(spark, folder)
