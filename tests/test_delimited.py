"""Delimited text whose quoted cells hold line breaks, read in splits of any size."""

import csv
import io
import random

import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from lotwise.sources import delimited, tables

CELLS = ["x", "two words", "a,b", 'in "quotes"', '"', '""', "line\nbreak", "\n", "\n\n,\"\n", "é\n" * 5, "z" * 90]


def written(rows, **style):
    held = io.StringIO()
    csv.writer(held, lineterminator=style.pop("end", "\n"), **style).writerows(rows)
    return held.getvalue()


def table(seed, size):
    pick = random.Random(seed)
    return [(f"k{i}", pick.choice(CELLS), pick.choice(CELLS)) for i in range(size)]


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def split_size(spark):
    key = "spark.sql.files.maxPartitionBytes"
    held = spark.conf.get(key)
    yield lambda size: spark.conf.set(key, str(size))
    spark.conf.set(key, held)


@pytest.mark.parametrize("size", [13, 64, 333, 1 << 20])
@pytest.mark.parametrize("quoting", [csv.QUOTE_MINIMAL, csv.QUOTE_ALL])
def test_every_record_comes_once_and_whole(spark, tmp_path, split_size, size, quoting):
    rows = table(size, 120)
    (tmp_path / "t").mkdir()
    for part in range(2):
        text = written([("k", "v", "w"), *rows[part::2]], quoting=quoting)
        (tmp_path / "t" / f"{part}.csv").write_text(text)
    split_size(size)
    df = tables.read_delimited(spark, str(tmp_path / "t"))
    assert df.columns == ["k", "v", "w"]
    assert rows_of(df) == sorted(rows)
    if size < 1000:
        lines = delimited._lines(spark, str(tmp_path / "t"))
        assert lines.rdd.getNumPartitions() > 10


@pytest.mark.parametrize("size", [16, 1 << 20])
def test_agrees_with_the_reader_of_whole_files(spark, tmp_path, split_size, size):
    text = (
        '﻿a,B,a,\r\n1,5" pipe,"say ""hi""",x\r\n\r\n2,"x\r\ny",,only\r\n3,few\r\n'
        '4,more,"",than,these\r\n"5",N/A, b ,"c"'
    )
    path = tmp_path / "odd.csv"
    path.write_text(text, newline="")
    whole = spark.read.csv(str(path), header=True, escape='"', multiLine=True)
    split_size(size)
    split = delimited.read(spark, str(path), ",")
    assert split.columns == whole.columns
    assert sorted(map(str, split.collect())) == sorted(map(str, whole.collect()))


def test_empty_files_and_headers_alone(spark, tmp_path, split_size):
    (tmp_path / "empty.csv").write_text("")
    assert delimited.read(spark, str(tmp_path / "empty.csv"), ",").count() == 0
    (tmp_path / "head.csv").write_text("a|b")
    df = tables.read_delimited(spark, str(tmp_path / "head.csv"), "|")
    assert (df.columns, df.count()) == (["a", "b"], 0)
    (tmp_path / "two.csv").write_text('a,"b\n' + "x" * 50 + '\nc"\n1,2\n')
    assert delimited.read(spark, str(tmp_path / "two.csv"), ",").columns == ["a", f"b\n{'x' * 50}\nc"]
    split_size(8)
    with pytest.raises(ValueError, match="header"):
        delimited.read(spark, str(tmp_path / "two.csv"), ",")


@given(st.lists(st.lists(st.text(alphabet='a,"\n', max_size=8), min_size=2, max_size=3), min_size=1, max_size=6))
def test_sides_follow_the_quotes(rows):
    text = written(rows)
    side, ends = delimited.OUTSIDE, 0
    for line in text.split("\n")[:-1]:
        side = delimited.side_after(line, side, ",") if line else side
        ends += side is delimited.OUTSIDE
    assert (side, ends) == (delimited.OUTSIDE, len(rows))


def test_small_blocks_share_tasks_and_stay_blocks(spark, tmp_path, split_size):
    rows = table(7, 300)
    (tmp_path / "t.csv").write_text(written([("k", "v", "w"), *rows]))
    split_size(16)
    lines = delimited._lines(spark, str(tmp_path / "t.csv"))
    assert lines.rdd.getNumPartitions() > 200
    gathered = delimited._gathered(lines)
    assert gathered.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert gathered.select("file_block_start").distinct().count() > 100
    texts, _ = delimited.records(spark, str(tmp_path / "t.csv"), ",")
    assert texts.rdd.getNumPartitions() <= 3 * spark.sparkContext.defaultParallelism
    assert rows_of(delimited.read(spark, str(tmp_path / "t.csv"), ",")) == sorted(rows)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_lines_without_quotes_come_as_they_are(spark, tmp_path, split_size, end):
    rows = [(f"k{i}", "ä" * (i % 5), "x") for i in range(200)]
    text = end.join("|".join(r) for r in [("k", "v", "w"), *rows, ("",)])
    (tmp_path / "t.csv").write_text(text.replace("k50|", f"{end}{end}k50|"), newline="")
    split_size(100)
    expected = sorted((k, v or None, w) for k, v, w in rows)
    assert sorted(rows_of(delimited.read(spark, str(tmp_path / "t.csv"), "|").na.fill("")), key=str) == sorted(
        ((k, v or "", w) for k, v, w in expected), key=str
    )


def test_lines_without_quotes_are_not_walked(monkeypatch):
    monkeypatch.setattr(delimited, "side_after", lambda *a: pytest.fail("a line was walked"))
    of_block = {"block": [1] * 3, "start": [64] * 3, "side": [False] * 3, "opener": [1] * 3, "returning": [False] * 3}
    batch = pa.RecordBatch.from_pydict({**of_block, "value": ["a|b", "", "c|d"]})
    out = [text for b in delimited.records_of("|")(iter([batch])) for text in b.column("text").to_pylist()]
    assert out == ["a|b", "c|d"]
