"""Files: archives, delimited text, XML, spreadsheets, GeoJSON, service pages."""

import io
import json
import zipfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lotwise.functions import geometry as G
from lotwise.schema import srid_of
from lotwise.sources import archives, geojson, listing, service, sinks, tables

XML = (
    "<Root><Card Parcel_Number='a' Card='1' Year_Built='1990'/>"
    "<Other Parcel_Number='b' Card='2'><Inner x='1'/></Other></Root>"
)
TXT = "PropertyNumber|UseCode|YearBuilt\n007|401|\n008|N/A|1,990\n"
CSV = 'PropertyNumber,UseCode,YearBuilt\n007,"4,01",1990\n'


def sheet(rows, shared):
    def cell(c, r, v):
        ref = f"{chr(65 + c)}{r}"
        if isinstance(v, str):
            if v in shared:
                return f'<c r="{ref}" t="s"><v>{shared.index(v)}</v></c>'
            return f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>'
        return "" if v is None else f'<c r="{ref}"><v>{v}</v></c>'

    body = "".join(
        f'<row r="{r}">' + "".join(cell(c, r, v) for c, v in enumerate(row)) + "</row>"
        for r, row in enumerate(rows, 1)
    )
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    strings = "".join(f"<si><r><t>{s[:2]}</t></r><r><t>{s[2:]}</t></r></si>" for s in shared)
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}>{strings}</sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")
        z.writestr("xl/worksheets/sheet2.xml", f"<worksheet {ns}><sheetData/></worksheet>")
    return held.getvalue()


XLSX = sheet(
    [["Parcel Number U", "Card", "Year Effective"], ["p1", 1, 1999], ["p2", None, 2003]],
    ["Parcel Number U", "Year Effective"],
)


@pytest.fixture(scope="module")
def zips(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("zips")
    for name in ("one", "two"):
        with zipfile.ZipFile(folder / f"{name}.zip", "w") as z:
            z.writestr("folder/", "")
            z.writestr("_skip.txt", "x")
            z.writestr("folder/cards.xml", XML)
            z.writestr("cards.txt", TXT)
            z.writestr("cards.csv", CSV)
            z.writestr("book.xlsx", XLSX)
            z.writestr("shape.shp", "x")
    return archives.read_archives(spark, str(folder))


def rows(df, *columns):
    return sorted(tuple(r) for r in df.orderBy("path", "row_no").select(*columns).collect())


def test_entries(zips):
    names = {(r["entry"], r["name"], r["extension"]) for r in archives.list_entries(zips).collect()}
    assert names == {
        ("folder/cards.xml", "cards.xml", "xml"),
        ("cards.txt", "cards.txt", "txt"),
        ("cards.csv", "cards.csv", "csv"),
        ("book.xlsx", "book.xlsx", "xlsx"),
        ("shape.shp", "shape.shp", "shp"),
    }
    assert archives.list_entries(zips).count() == 10


def test_extract(zips):
    got = archives.extract(zips).where("extension = 'txt'").select("name", "content").collect()
    assert [(r["name"], bytes(r["content"]).decode()) for r in got] == [("cards.txt", TXT)] * 2
    assert archives.extract(zips).count() == 10


def test_xml_records_whatever_their_tag(zips):
    df = archives.read_entry(zips, "folder/cards.xml")
    assert df.columns == ["path", "row_no", "Parcel_Number", "Card", "Year_Built"]
    got = df.select("row_no", "Parcel_Number", "Card", "Year_Built").collect()
    assert sorted(map(tuple, got)) == [(0, "a", "1", "1990")] * 2 + [(1, "b", "2", None)] * 2


def test_text_tables_stay_text(zips):
    df = archives.read_entry(zips, "cards.txt", ["PropertyNumber", "YearBuilt"])
    got = {tuple(r) for r in df.select("PropertyNumber", "YearBuilt").collect()}
    assert got == {("007", None), ("008", "1,990")}
    df = archives.read_entry(zips, "cards.csv")
    assert {tuple(r) for r in df.drop("path").collect()} == {(0, "007", "4,01", "1990")}


def test_spreadsheet(zips):
    df = archives.read_entry(zips, "book.xlsx", ["Parcel Number U", "Year Effective"])
    got = {tuple(r) for r in df.drop("path").collect()}
    assert got == {(0, "p1", "1999"), (1, "p2", "2003")}


def test_missing_columns_and_entries_fail(zips):
    for entry in ("cards.txt", "cards.csv", "book.xlsx", "folder/cards.xml"):
        with pytest.raises(PySparkException):
            archives.read_entry(zips, entry, ["NoSuch"]).collect()
    with pytest.raises(ValueError):
        archives.read_entry(zips, "absent.txt")
    with pytest.raises(ValueError):
        archives.read_entry(zips, "shape.shp")


def test_attributes_that_few_records_have(spark, tmp_path):
    """Columns are looked for in the whole file, not in its first records."""
    records = "".join(f'<r A="{i}"/>' for i in range(10_000)) + '<r A="last" B="b"/>'
    with zipfile.ZipFile(tmp_path / "sparse.zip", "w") as z:
        z.writestr("t.xml", f"<all>{records}</all>")
    df = archives.read_entry(archives.read_archives(spark, str(tmp_path)), "t.xml", ["A", "B"])
    assert df.count() == 10_001
    assert [r["A"] for r in df.where("B = 'b'").collect()] == ["last"]


def test_delimited_and_xml_files(spark, tmp_path):
    (tmp_path / "cards.txt").write_text(TXT)
    (tmp_path / "cards.xml").write_text(XML)
    df = tables.read_delimited(spark, str(tmp_path / "cards.txt"), "|")
    assert {tuple(r) for r in df.collect()} == {("007", "401", None), ("008", None, "1,990")}
    with pytest.raises(ValueError):
        tables.read_delimited(spark, str(tmp_path / "cards.txt"), "|", ["NoSuch"])
    df = tables.read_xml_records(
        spark, str(tmp_path / "cards.xml"), "Card", ["Parcel_Number", "Year_Built"]
    )
    assert [tuple(r) for r in df.collect()] == [("a", "1990")]


def test_geojson_collection_and_lines(spark, tmp_path):
    ring = [[0, 0], [2, 0], [2, 2], [0, 0]]
    collection = {
        "type": "FeatureCollection",
        "features": [
            {"type": "Feature", "properties": {"id": 1, "n": "a"},
             "geometry": {"type": "Polygon", "coordinates": [ring]}},
            {"type": "Feature", "properties": {"id": 2, "n": None},
             "geometry": {"type": "MultiPolygon", "coordinates": [[ring], [ring]]}},
            {"type": "Feature", "properties": {"id": 3}, "geometry": None},
        ],
    }
    path = tmp_path / "layer.json"
    path.write_text(json.dumps(collection, indent=1))
    df = geojson.read_geojson(spark, str(path), "id:bigint,n:string")
    got = df.orderBy("id").select("id", "n", G.area("geometry")).collect()
    assert [tuple(r) for r in got] == [(1, "a", 2.0), (2, None, 4.0), (3, None, None)]
    geojson.write_geojson(df, str(tmp_path / "lines"))
    back = geojson.read_geojson_lines(spark, str(tmp_path / "lines"), "id:bigint,n:string")
    assert back.exceptAll(df).count() == 0 and back.count() == 3


def landed(root, features, page, wkid=4269, fields=("LSN", "NAME")):
    def put(name, text):
        (root / name).mkdir(parents=True)
        (root / name / "reply.json").write_text(text)

    put("count", json.dumps({"properties": {"count": len(features)}}))
    meta = {
        "maxRecordCount": page,
        "extent": {"spatialReference": {"wkid": 1, "latestWkid": wkid}},
        "fields": [{"name": f} for f in fields],
    }
    put("meta", json.dumps(meta))
    for offset in range(0, len(features), page):
        put(f"pages/offset={offset}", json.dumps({"features": features[offset : offset + page]}))
    return str(root)


def test_service_scan(spark, tmp_path):
    features = [
        {"properties": {"LSN": i, "NAME": f"n{i}"},
         "geometry": {"type": "Point", "coordinates": [float(i), -float(i)]}}
        for i in range(7)
    ]
    root = landed(tmp_path / "svc", features, 3)
    pages = service.read_pages(spark, root)
    assert sorted(r["offset"] for r in pages.collect()) == [0, 3, 6]
    assert pages.where("offset >= 3").count() == 2
    plan = pages.where("offset >= 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "offset" in plan.split("PartitionFilters: [")[1].split("]")[0]
    df = service.read_service(spark, root, "LSN:bigint,NAME:string", kind="point", columns=["LSN"])
    assert df.columns == ["LSN", "point"] and srid_of(df, "point") == 4269
    assert sorted((r["LSN"], r["point"]["y"]) for r in df.collect()) == [
        (i, -float(i)) for i in range(7)
    ]
    with pytest.raises((PySparkException, ValueError)):
        service.read_service(spark, root, "NOPE:string", columns=["NOPE"]).collect()


def point_features(n):
    return [
        {"properties": {"LSN": i, "NAME": f"n{i}"}, "geometry": {"type": "Point", "coordinates": [float(i), 0.0]}}
        for i in range(n)
    ]


def test_small_pages_share_a_task(spark, tmp_path):
    root = landed(tmp_path / "svc", point_features(60), 1)
    assert service.read_pages(spark, root).rdd.getNumPartitions() <= 20


def test_only_wanted_fields_are_decoded(spark, tmp_path):
    root = landed(tmp_path / "svc", point_features(7), 3)
    df = service.read_service(spark, root, "LSN:bigint,NAME:string", kind="point", columns=["LSN"])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "NAME" not in plan
    assert sorted(r["LSN"] for r in df.collect()) == list(range(7))


def test_pages_that_do_not_add_up_fail(spark, tmp_path):
    features = point_features(7)
    short = landed(tmp_path / "short", features, 3)
    (tmp_path / "short/pages/offset=3/reply.json").write_text(json.dumps({"features": features[3:5]}))
    with pytest.raises(PySparkException, match="page at offset 3 holds 2 features, not 3"):
        service.read_service(spark, short, "LSN:bigint", kind="point").collect()
    twice = landed(tmp_path / "twice", features, 3)
    (tmp_path / "twice/pages/offset=3/again.json").write_text(json.dumps({"features": features[3:6]}))
    with pytest.raises(ValueError, match="offset 3: landed 2 times"):
        service.read_pages(spark, twice)
    missing = landed(tmp_path / "missing", features, 3)
    (tmp_path / "missing/pages/offset=6/reply.json").rename(tmp_path / "missing/pages/offset=6/_gone")
    with pytest.raises(ValueError, match="offset 6: landed 0 times"):
        service.read_pages(spark, missing)
    more = landed(tmp_path / "more", features, 3)
    (tmp_path / "more/count/reply.json").write_text('{"count": 6}')
    with pytest.raises(ValueError, match="offset 6: not planned"):
        service.read_pages(spark, more)
    (tmp_path / "more/count/reply.json").write_text("none")
    with pytest.raises(ValueError, match="no number"):
        service.read_pages(spark, more)


def test_live_pages_are_fetched_in_tasks(spark):
    def fetch(offset, n):
        made = [{"properties": {"LSN": i}, "geometry": None} for i in range(offset, offset + n)]
        return json.dumps({"features": made})

    plan = service.page_plan(spark, 95, 10)
    pages = service.fetched_pages(plan, fetch, tasks=3)
    assert pages.rdd.getNumPartitions() == 3
    rows = service.geojson_features(pages, "LSN:bigint", kind="point").collect()
    assert sorted(r["LSN"] for r in rows) == list(range(95))


def test_empty_service(spark, tmp_path):
    root = landed(tmp_path / "svc", [], 3)
    assert service.read_pages(spark, root).count() == 0


def test_metadata_and_page_plan(spark):
    meta = (
        '{"maxRecordCount": 2000, "extent": {"spatialReference": {"latestWkid": 3735}},'
        ' "fields": [{"name": "A"}, {"name": "B"}]}'
    )
    df = spark.createDataFrame([(meta, "{'count': 5}"), (meta, "0")], "m string, c string")
    got = df.select(
        service.service_metadata("m").alias("m"),
        service.page_offsets(service.record_count("c"), 2).alias("o"),
    ).collect()
    assert got[0]["m"].asDict() == {"page_size": 2000, "srid": 3735, "fields": ["A", "B"]}
    assert [r["o"] for r in got] == [[0, 2, 4], []]


def test_esri_rings(spark):
    outer = [[0, 0], [0, 10], [10, 10], [10, 0], [0, 0]]  # clockwise
    hole = [[2, 2], [4, 2], [4, 4], [2, 4], [2, 2]]  # counter-clockwise
    far = [[20, 0], [20, 1], [21, 1], [21, 0], [20, 0]]
    body = json.dumps(
        {
            "features": [
                {"attributes": {"ID": 1}, "geometry": {"rings": [outer, hole, far]}},
                {"attributes": {"ID": 2}, "geometry": None},
                {"attributes": {"ID": 3}, "geometry": {"rings": []}},
            ]
        }
    )
    pages = spark.createDataFrame([(body,)], "body string")
    got = service.esri_polygons(pages, "ID:bigint").orderBy("ID")
    assert [r[0] for r in got.select(G.area("geometry")).collect()] == [97.0, None, 0.0]
    assert [len(p) for p in got.first()["geometry"]] == [2, 1]
    first = service.esri_polygons(pages, "ID:bigint", rings="first").orderBy("ID")
    assert [r[0] for r in first.select(G.area("geometry")).collect()] == [100.0, None, None]
    body = '{"features": [{"attributes": {"ID": 1}, "geometry": {"y": 39.9, "x": -83.1}}]}'
    point = service.esri_points(spark.createDataFrame([(body,)], "body string"), "ID:bigint")
    assert tuple(point.first()["point"]) == (-83.1, 39.9)


def test_links(spark):
    html = '<a href="a1.zip">a1.zip</a><a href="b.txt">b</a><a href="a2.zip">a2</a>'
    df = spark.createDataFrame([(html,), ("none",)], "html string")
    pattern = 'href="([^"]*)"'
    got = df.select(
        listing.links("html", pattern),
        listing.last_link("html", pattern, ".zip"),
        listing.last_link("html", pattern, ".gdb"),
    ).collect()
    assert tuple(got[0]) == (["a1.zip", "b.txt", "a2.zip"], "a2.zip", None)
    assert tuple(got[1]) == ([], None, None)


def test_county_folders(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "franklin"), (2, "union")], "id int, COUNTY string")
    sinks.write_counties(df, path)
    sinks.write_counties(df.where("COUNTY = 'union'").withColumn("id", F.lit(9)), path)
    assert sorted(map(tuple, tables.read_counties(spark, path).collect())) == [
        (1, "franklin"), (9, "union"),
    ]
    some = tables.read_counties(spark, path, ["union"])
    assert [r["id"] for r in some.collect()] == [9]
    assert "PartitionFilters: [isnotnull(COUNTY" in some._jdf.queryExecution().executedPlan().toString()
    sinks.append_rows(df, str(tmp_path / "rows"))
    sinks.append_rows(df, str(tmp_path / "rows"))
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 4


def test_union_of_counties(spark):
    a = spark.createDataFrame([(1, 2.0)], "id int, ACRES double")
    b = spark.createDataFrame([(3,)], "id int")
    out = tables.union_counties({"franklin": a, "fairfield": b})
    assert sorted(map(tuple, out.select("COUNTY", "id", "ACRES").collect())) == [
        ("fairfield", 3, None), ("franklin", 1, 2.0),
    ]


@pytest.mark.parametrize("body", ['{"features": [', '{"error": {"code": 400}}'])
def test_broken_page_raises(spark, body):
    pages = spark.createDataFrame([(body,)], "body string")
    with pytest.raises(Exception, match="features|MALFORMED"):
        service.geojson_features(pages, "LSN:bigint").collect()


def test_text_that_must_not_be_read_by_line_or_position(spark, tmp_path):
    broken = tmp_path / "broken.csv"
    broken.write_text('a,b\n1,"x\ny"\n2,z\n')
    rows = tables.read_delimited(spark, str(broken)).collect()
    assert [tuple(r) for r in rows] == [("1", "x\ny"), ("2", "z")]
    mixed = tmp_path / "mixed"
    mixed.mkdir()
    (mixed / "1.csv").write_text("a,b\n1,2\n")
    (mixed / "2.csv").write_text("b,a\n2,1\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        tables.read_delimited(spark, str(mixed)).collect()


def test_xml_attributes_are_checked(spark, tmp_path):
    path = tmp_path / "cards.xml"
    path.write_text('<R><Card a="1" b="x"/><Card a="2"/></R>')
    read = tables.read_xml_records(spark, str(path), "Card")
    assert sorted(tuple(r) for r in read.select("a", "b").collect()) == [("1", "x"), ("2", None)]
    with pytest.raises(ValueError):
        tables.read_xml_records(spark, str(path), "Card", ["a", "c"])
