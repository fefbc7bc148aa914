"""County jobs from files: what has not changed is not built again."""

import pytest

from lotwise.plans import files
from lotwise.schema import with_srid
from lotwise.sources import tables
from tests.shapes import STRING, rectangle, shape_table

HEAD = "PropertyNumber|UseCode|YearBuilt\n"


@pytest.fixture
def raw(spark, tmp_path):
    root = tmp_path / "raw"
    lots = shape_table(spark, [("a", "1.5", rectangle(0, 0, 9, 9)), ("b", "2", rectangle(9, 0, 12, 9))],
                       ("Name", STRING), ("A_Acreage", STRING))
    with_srid(lots, 3735).write.parquet(f"{root}/morrow/parcels")
    for table, text in (("building", "a|401|1990\nb|401|\n"), ("dwelling", "b|510|1980\nz|510|1970\n")):
        (root / "morrow" / table).mkdir()
        (root / "morrow" / table / "extract.txt").write_text(HEAD + text)
    return root


def rows(spark, root):
    df = spark.read.parquet(f"{root}/cards/morrow").select("property", "land_use", "year_built")
    return sorted(tuple(r) for r in df.collect())


def test_only_changed_counties_are_built(spark, raw, tmp_path):
    root = str(tmp_path / "out")
    assert files.build_changed(spark, str(raw), root, ["morrow"]) == ["morrow"]
    assert rows(spark, root) == [("a", "401", "1990"), ("b", "510", "1980")]
    assert files.build_changed(spark, str(raw), root, ["morrow"]) == []
    (raw / "morrow" / "building" / "more.txt").write_text(HEAD + "b|402|2001\n")
    assert files.build_changed(spark, str(raw), root, ["morrow"]) == ["morrow"]
    assert rows(spark, root)[-2:] == [("b", "402", "2001"), ("b", "510", "1980")]
    assert files.recorded(spark, root).count() == 3


def test_a_run_that_fails_leaves_no_record(spark, raw, tmp_path, monkeypatch):
    root = str(tmp_path / "out")

    def lost(*_):
        raise RuntimeError("lost")

    job = files.JOBS["morrow"]
    monkeypatch.setitem(files.JOBS, "morrow", files.Job(job.tables, job.build, lost))
    with pytest.raises(RuntimeError):
        files.build_changed(spark, str(raw), root, ["morrow"])
    monkeypatch.undo()
    assert files.recorded(spark, root).count() == 0
    assert files.build_changed(spark, str(raw), root, ["morrow"]) == ["morrow"]


def test_missing_tables_fail(spark, raw, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.build_changed(spark, str(raw), str(tmp_path / "out"), ["knox"])


def test_every_county_has_a_job():
    assert len(files.JOBS) == 10


def test_text_tables_of_a_county_are_parsed_once(spark, tmp_path):
    rows = [(f"p{i}", "510" if i % 2 else None) for i in range(50)]
    spark.createDataFrame(rows, "k string, u string").write.csv(str(tmp_path / "t"), sep="|", header=True)
    df = files.pipe_text(spark, str(tmp_path / "t"))
    assert sorted(map(tuple, df.na.fill("").collect())) == sorted((k, u or "") for k, u in rows)
    # what is read from here on is the written table, not the text
    assert all(f.endswith(".parquet") for f in df.inputFiles())


def test_filters_on_cells_do_not_parse_again(spark, tmp_path):
    spark.createDataFrame([("a", "b")], "k string, u string").write.csv(str(tmp_path / "t"), header=True)
    df = tables.read_delimited(spark, str(tmp_path / "t")).dropna(how="any")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # one for records that lie in a block, one for those put together
    assert 1 <= plan.count("from_csv") <= 2
