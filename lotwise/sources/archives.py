"""Zip archives: list entries, and read one entry as a table.

Archives come as (path, content), as Spark's ``binaryFile`` reader gives them. An
entry is decoded as a stream, in batches, by the task that holds its archive; Spark
spreads the archives. Every value is text, as it stands in the file.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.functions.values import base_name, extension
from lotwise.schema import require_columns
from lotwise.sources.tables import MISSING_WORDS

BATCH_ROWS = 10_000
KINDS = ("xml", "csv", "txt", "xlsx")
SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


# --- entries ------------------------------------------------------------------


def _entry_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                infos = z.infolist()
            yield pd.DataFrame(
                {
                    "path": path,
                    "entry": [i.filename for i in infos],
                    "size": [i.file_size for i in infos],
                }
            )


def list_entries(archives: DataFrame) -> DataFrame:
    """(path, entry, size, name, extension) of the files in the archives.

    Folders and entries that start with an underscore are left out; ``name`` is the
    entry without its folders.
    """
    entries = archives.mapInPandas(_entry_rows, "path string, entry string, size bigint")
    return entries.where(
        ~F.col("entry").startswith("_") & ~F.col("entry").endswith("/")
    ).select(
        "path",
        "entry",
        "size",
        base_name("entry").alias("name"),
        extension("entry").alias("extension"),
    )


def extract(archives: DataFrame) -> DataFrame:
    """(path, entry, name, extension, content): the files in the archives, one row each.

    Entries come one at a time, so a task holds one archive and one entry. The same
    entries are left out as in ``list_entries``.
    """

    def contents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in z.namelist():
                        if not name.startswith("_") and not name.endswith("/"):
                            yield pd.DataFrame(
                                {"path": [path], "entry": [name], "content": [z.read(name)]}
                            )

    files = archives.mapInPandas(contents, "path string, entry string, content binary")
    return files.select(
        "path",
        "entry",
        base_name("entry").alias("name"),
        extension("entry").alias("extension"),
        "content",
    )


# --- tables -------------------------------------------------------------------


def _delimited(stream, sep: str, columns: list[str] | None) -> Iterator[pd.DataFrame]:
    """Text tables; pandas itself fails on a column that is not there."""
    yield from pd.read_csv(stream, sep=sep, dtype=str, usecols=columns, chunksize=BATCH_ROWS)


def _batches(rows: Iterator[dict]) -> Iterator[pd.DataFrame]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == BATCH_ROWS:
            yield pd.DataFrame(held, dtype=object)
            held = []
    yield pd.DataFrame(held, dtype=object)


def _xml_rows(stream) -> Iterator[dict]:
    """Attributes of the root's children, whatever their tag."""
    depth, root = 0, None
    for event, element in ElementTree.iterparse(stream, events=("start", "end")):
        if event == "start":
            depth += 1
            root = element if root is None else root
        else:
            depth -= 1
            if depth == 1:
                yield dict(element.attrib)
                root.clear()


def _xlsx_rows(stream) -> Iterator[dict]:
    """First sheet: the first row names the columns."""
    book = zipfile.ZipFile(io.BytesIO(stream.read()))
    shared = []
    if "xl/sharedStrings.xml" in book.namelist():
        for _, item in ElementTree.iterparse(book.open("xl/sharedStrings.xml")):
            if item.tag == f"{SHEET}si":
                shared.append("".join(t.text or "" for t in item.iter(f"{SHEET}t")))
                item.clear()
    sheets = [n for n in book.namelist() if re.fullmatch(r"xl/worksheets/sheet[0-9]+\.xml", n)]
    first = min(sheets, key=lambda n: int(re.search("[0-9]+", n).group()))
    header = None
    for _, row in ElementTree.iterparse(book.open(first)):
        if row.tag != f"{SHEET}row":
            continue
        cells = {}
        for cell in row.iter(f"{SHEET}c"):
            column = re.match("[A-Z]+", cell.get("r", "")).group()
            value = cell.find(f"{SHEET}v")
            if cell.get("t") == "inlineStr":
                text = "".join(t.text or "" for t in cell.iter(f"{SHEET}t"))
            elif value is None:
                text = None
            elif cell.get("t") == "s":
                text = shared[int(value.text)]
            else:
                text = value.text
            cells[column] = None if text in MISSING_WORDS else text
        row.clear()
        if header is None:
            header = cells
        else:
            yield {name: cells.get(column) for column, name in header.items()}


def _decode(stream, kind: str, columns: list[str] | None) -> Iterator[pd.DataFrame]:
    if kind == "csv":
        return _delimited(stream, ",", columns)
    if kind == "txt":
        return _delimited(stream, "|", columns)
    return _batches(_xml_rows(stream) if kind == "xml" else _xlsx_rows(stream))


def _kind(entry: str) -> str:
    kind = entry.rsplit(".", 1)[-1]
    if kind not in KINDS:
        raise ValueError(f"cannot read {entry!r}; known types: {KINDS}")
    return kind


def entry_columns(archives: DataFrame, entry: str) -> list[str]:
    """Column names of an entry over all archives, in order of appearance."""
    kind = _kind(entry)

    def names(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    if entry in z.namelist():
                        with z.open(entry) as stream:
                            seen = {}
                            for table in _decode(stream, kind, None):
                                seen.update((str(c), len(seen)) for c in table.columns if c not in seen)
                        yield pd.DataFrame({"name": seen.keys(), "place": seen.values()})

    found = archives.mapInPandas(names, "name string, place int")
    ordered = found.groupBy("name").agg(F.min("place").alias("place")).orderBy("place", "name")
    columns = [r["name"] for r in ordered.collect()]
    if not columns:
        raise ValueError(f"no archive holds the entry {entry!r}")
    return columns


def read_entry(
    archives: DataFrame, entry: str, columns: list[str] | None = None
) -> DataFrame:
    """One entry of each archive as a table of texts, by its extension.

    Adds ``path`` and ``row_no``, the row's place in its file. A column that the
    entry lacks is an error; without ``columns`` the files are read for their names.
    """
    kind = _kind(entry)
    wanted = list(columns) if columns is not None else entry_columns(archives, entry)
    strict = columns is not None
    schema = T.StructType(
        [T.StructField("path", T.StringType()), T.StructField("row_no", T.LongType())]
        + [T.StructField(c, T.StringType()) for c in wanted]
    )

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    if entry not in z.namelist():
                        continue
                    with z.open(entry) as stream:
                        done, names = 0, set()
                        for table in _decode(stream, kind, wanted if strict else None):
                            names.update(table.columns)
                            table = table.reindex(columns=wanted).astype(object)
                            table = table.where(table.notna(), None)
                            table.insert(0, "path", path)
                            table.insert(1, "row_no", range(done, done + len(table)))
                            done += len(table)
                            yield table
                        # of the whole file: records may lack what others have
                        if strict and done:
                            require_columns(sorted(names), wanted)

    return archives.mapInPandas(rows, schema)
