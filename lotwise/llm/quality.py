"""Quality rules by hashed n-gram log-likelihood ratio.

Words and pairs of neighbouring words are hashed into a fixed number of buckets. Two
multinomials over the buckets are counted: one over trusted documents (the target),
one over the whole corpus (raw). A document's score is the mean, over its n-grams, of
log(target / raw); it is kept when the score reaches a fixed threshold. Nothing is
drawn at random, so equal texts get equal verdicts.

The trusted documents are all those labelled good, found by a join that deals texts out
by id (ids of very many rows are salted). The raw multinomial covers every document.
Buckets are summed in the tasks before they are shuffled, and only the fixed number of
buckets reaches the driver.

Edge cases: a null or empty text has no words and fails the base rules; without trusted
documents every score is 0 and only the base rules decide; repeated rows are judged
alike, each in its own row; null ids are kept as they are; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.words import ALL_BUT_BLANKS, K, Block, blocks, mix, windows
from lotwise.operators.skew import salted_left

BUCKETS = 1 << 16
SMOOTHING = 10.0
THRESHOLD = -0.1

LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
REPEAT_WINDOW = 8

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
STARTS_CODE_POINT = (np.arange(256) & 0xC0) != 0x80

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, score double"
)


def grams(block: Block, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text number of every word and of every pair of words."""
    hashes, text = block.hashes(), block.text_of_word()
    pairs = windows(hashes, 2)
    same = text[1:] == text[:-1] if len(text) else np.zeros(0, bool)
    pairs = pairs[same[: len(pairs)]]
    both = np.concatenate([mix(hashes + K), pairs])
    where = np.concatenate([text, text[:-1][same] if len(text) else text])
    return (both % np.uint64(buckets)).astype(np.int64), where


def counts_of(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """n-grams of all texts, by bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for block in blocks(batch.column(0)):
                block.words(ALL_BUT_BLANKS)
                counts += np.bincount(grams(block, buckets)[0], minlength=buckets)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(counts[seen])], names=["bucket", "n"])

    rows = texts.select("text").mapInArrow(count, "bucket int, n long")
    table = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets)
    out[table["bucket"].to_numpy()] = table["n"].to_numpy()
    return out


def trusted(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The texts of all documents labelled good."""
    ids = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    named = documents.where("doc_id is not null").select("doc_id", "text")
    named, (ids,), on = salted_left(named, [ids], ["doc_id"])
    # dealt out by id at every size: the labels grow with the documents
    return named.join(ids.hint("merge"), on, "left_semi").select("text")


def fit(
    documents: DataFrame,
    labels: DataFrame,
    buckets: int = BUCKETS,
    smoothing: float = SMOOTHING,
) -> np.ndarray:
    """log(target / raw) by bucket; zeros without trusted documents."""
    raw, target = counts_of(documents, buckets), counts_of(trusted(documents, labels), buckets)
    if not target.sum():
        return np.zeros(buckets)
    # the target count that the raw multinomial lets expect; smoothing draws buckets of
    # little evidence, such as a document's own rare words, towards 0
    expected = raw * (target.sum() / raw.sum())
    return np.log((target + smoothing) / (expected + smoothing))


def repeated_words(block: Block, hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """By text, the words inside a run of REPEAT_WINDOW words that the text holds twice."""
    at = np.flatnonzero(block.room() >= REPEAT_WINDOW)
    covered = np.zeros(len(hashes) + 1, np.int64)
    if len(at):
        keys = windows(hashes, REPEAT_WINDOW)[at] ^ mix(text[at].astype(np.uint64))
        order = np.argsort(keys)
        ranked = keys[order]
        equal = ranked[1:] == ranked[:-1]
        twice = np.concatenate([[False], equal]) | np.concatenate([equal, [False]])
        hit = at[order[twice]]
        np.add.at(covered, hit, 1)
        np.add.at(covered, np.minimum(hit + REPEAT_WINDOW, len(hashes)), -1)
    return np.bincount(text[np.cumsum(covered[:-1]) > 0], minlength=block.n)


def repeated_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def judged(texts: pa.Array, weights: np.ndarray, threshold: float) -> Iterator[tuple]:
    """By block: its first text, the five counts, base_failed, kept and the score."""
    for block in blocks(texts):
        block.words(ALL_BUT_BLANKS)
        data = block.bytes
        n_words = np.diff(block.bounds)
        chars = block.per_text(ALL_BUT_BLANKS[data] & STARTS_CODE_POINT[data])
        symbols = block.per_text(SYMBOLS[data])
        own = texts.slice(block.first, block.n).cast(pa.binary())
        lines = np.array([repeated_lines(x) if x else 0 for x in own.to_pylist()], np.int64)
        hashes, text = block.hashes(), block.text_of_word()
        repeats = repeated_words(block, hashes, text)
        bucket, where = grams(block, len(weights))
        size = np.bincount(where, minlength=block.n)
        total = np.bincount(where, weights=weights[bucket], minlength=block.n)
        mean = total / np.maximum(size, 1)
        failed = (n_words < LEAST_WORDS) | (100 * repeats > MOST_REPEATED_PERCENT * n_words)
        counts = [x.astype(np.int64) for x in (n_words, chars, symbols, lines, repeats)]
        yield block.first, counts, failed, ~failed & (mean >= threshold), mean


def judge(
    documents: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD
) -> DataFrame:
    """One row per document with its counts, score and verdict."""
    shared = documents.sparkSession.sparkContext.broadcast(weights.astype(np.float64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, counts, *verdict in judged(batch.column(1), shared.value, threshold):
                ids = batch.column(0).slice(first, len(counts[0])).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids, *map(pa.array, counts), *map(pa.array, verdict)],
                    names=[c.split()[0] for c in SCHEMA.split(", ")],
                )

    return documents.select("doc_id", "text").mapInArrow(run, SCHEMA)


def kept(documents: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that pass, with all their columns, without a shuffle."""
    shared = documents.sparkSession.sparkContext.broadcast(weights.astype(np.float64))
    at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [x[3] for x in judged(batch.column(at), shared.value, threshold)]
            if rows:
                yield batch.filter(pa.array(np.concatenate(rows)))

    return documents.mapInArrow(run, documents.schema)


def quality(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Fit both multinomials and judge every document."""
    return judge(documents, fit(documents, labels), threshold)
