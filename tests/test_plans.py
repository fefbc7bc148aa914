"""County and region jobs on small hand-made tables."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from lotwise import session
from lotwise.plans import counties, jobs, region, summary
from lotwise.schema import PARCEL_SCHEMA, srid_of, to_parcel_schema, with_srid
from lotwise.sources import tables
from tests.shapes import LONG, STRING, point_table, rectangle, shape_table

A, B, C = rectangle(0, 0, 10, 10), rectangle(10, 0, 20, 10), rectangle(40, 0, 50, 10)


def addresses(spark, points, name="LSN"):
    df = point_table(spark, points).withColumnRenamed("pid", name)
    return with_srid(df, 3735, "point")


def parcels(spark, rows, *names):
    fields = [("row_id", LONG)] + [(n, STRING) for n in names]
    return with_srid(shape_table(spark, rows, *fields), 3735)


def table(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_franklin(spark):
    rows = [
        (1, "P1", "510", "1.0", "5", A),
        (2, "P1", "511", "2.0", "4", B),
        (3, "P2", None, "3.0", "9", C),
        (4, "P3", "401", "1.0", "8", C),
        (5, "WATER", "401", "1.0", "8", C),
        (6, "VNP9", "401", "1.0", "8", C),
    ]
    df = parcels(spark, rows, "PARCELID", "CLASSCD", "ACRES", "TOTVALUEBASE")
    df = df.withColumn("ACRES", F.col("ACRES").cast("double")).withColumn(
        "TOTVALUEBASE", F.col("TOTVALUEBASE").cast("double")
    )
    cards = spark.createDataFrame(
        [("P1-00", 1990.0), ("P1-00", 2001.0), ("P9-00", 1.0)], "OBJECTID string, YRBLT double"
    )
    # one address on the edge that the two lots of P1 share
    points = addresses(spark, [(1.0, 1.0), (10.0, 5.0), (45.0, 5.0), (99.0, 99.0)])
    out = counties.standard_table(counties.FRANKLIN, df, points, cards)
    assert srid_of(out) == 3735
    got = table(out, "OBJECTID", "CLASS", "ACRES", "APPRTOT", "UNITS", "YRBUILT")
    assert got == [("P1-00", "510", 1.0, 5.0, 2, 2001.0), ("P2-00", "401", 3.0, 9.0, 1, None)]


def test_union_drops_unreadable_first_ids(spark):
    rows = [
        (1, "junk", "1", "1990", "1", "1", A),
        (2, "007", "2", "1991", "2", "2", A),
        (3, "008", "3", "x", "3", "3", B),
        (4, "008", "3", "x", "3", "3", B),
        (5, None, "3", "1", "3", "3", C),
    ]
    df = parcels(
        spark, rows, "ParcelNo", "PARCELCLASS", "yearBuilt", "Acreage", "appraisedTotalValue"
    )
    points = addresses(spark, [(11.0, 1.0), (12.0, 1.0), (1.0, 1.0)], "AddressID")
    out = counties.standard_table(counties.UNION, df, points)
    got = table(out, "OBJECTID", "CLASS", "YRBUILT", "ACRES", "APPRTOT", "UNITS")
    assert got == [("8", "3", None, 3.0, 3.0, 2)]


def test_delaware_counts_before_it_collapses(spark):
    rows = [
        (1, "b", "1", "1990", "1.5", "7", A),
        (2, "a", None, "1995", "1.0", "9", A),
        (3, "a", "2", "1980", "2.0", "8", B),
    ]
    df = parcels(spark, rows, "OBJECTID", "CLASS", "YRBUILT", "ACRES", "TAXABLE_TO")
    points = addresses(spark, [(1.0, 1.0), (15.0, 1.0)])
    out = counties.standard_table(counties.DELAWARE, df, points)
    # id a keeps its first shape; both ids then share shape A and id a comes first
    got = table(out, "OBJECTID", "CLASS", "YRBUILT", "ACRES", "APPRTOT", "UNITS")
    assert got == [("a", "2", 1995, 2.0, 9.0, 2)]


def test_standard_schema_is_shared_by_counties(spark):
    rows = [(1, "x", "1900|1950|", "510", "1", "2", A)]
    df = parcels(spark, rows, "Parcel", "PPYearBuilt", "PPClassNumber", "PPAcres", "PPTotalValue")
    pickaway = counties.standard_table(counties.PICKAWAY, df, addresses(spark, [(1.0, 1.0)]))
    assert pickaway.first()["YRBUILT"] == ""
    standard = to_parcel_schema(pickaway)
    assert [(f.name, f.dataType) for f in standard.schema] == [
        (f.name, f.dataType) for f in PARCEL_SCHEMA
    ]
    assert standard.first()["YRBUILT"] is None and srid_of(standard) == 3735
    both = tables.union_counties({"pickaway": standard, "union": standard.drop("ACRES")})
    assert srid_of(both) == 3735 and both.count() == 2


def test_region_from_county_tables(spark):
    lot = rectangle(1828000, 714000, 1828200, 714200)
    house = parcels(spark, [(1, "a", "510", "1990", lot)], "OBJECTID", "CLASS", "YRBUILT")
    flat = house.withColumn("CLASS", F.lit("401")).withColumn("YRBUILT", F.lit("junk"))
    bare = parcels(spark, [(1, "n", "510", "1990", None)], "OBJECTID", "CLASS", "YRBUILT")
    union = tables.union_counties(
        {n: to_parcel_schema(d.withColumn("UNITS", F.lit(7))) for n, d in
         (("franklin", house), ("union", flat), ("licking", bare))}
    )
    juris = with_srid(
        shape_table(spark, [("PLACE", "Franklin", rectangle(1820000, 710000, 1830000, 720000))],
                    ("PLACECOMBO", STRING), ("COUNTY", STRING)), 3735,
    )
    out = region.region_table(union, juris)
    got = table(out, "COUNTY", "TYPE", "YRBUILT", "UNITS", "PLACECOMBO", "x", "y")
    assert got == [
        ("franklin", "SF-LL", 1990.0, 1, "PLACE", 1828100.0, 714100.0),
        ("union", "MF", None, 7, "PLACE", 1828100.0, 714100.0),
    ]
    acres = out.first()["CALCACRES"]
    assert abs(acres - 40000 / 43560) < 1e-3
    rows = summary.choropleth_rows(summary.analysis(out))
    assert table(summary.choropleth_jurisdictions(juris, rows), "PLACECOMBO") == [("PLACE",)]


def test_jobs_from_files_to_files(spark, tmp_path):
    root = str(tmp_path)
    names = ("Parcel", "PPYearBuilt", "PPClassNumber", "PPAcres", "PPTotalValue")
    near, far = rectangle(1828000, 714000, 1828100, 714100), rectangle(1, 1, 2, 2)
    raw = parcels(spark, [(1, "a", "1900|1970", "510", "1", "20", near),
                          (2, "b", "1980", "401", "1", "30", far)], *names)
    points = addresses(spark, [(1828050.0, 714050.0), (1828051.0, 714050.0)])
    jobs.build_county("pickaway", raw, points, root)
    lots = parcels(spark, [(1, "u", "520", "1999", near)], "OBJECTID", "CLASS", "YRBUILT")
    jobs.save_county(lots.withColumn("UNITS", F.lit(4)), "franklin", root)
    jobs.save_county(lots, "elsewhere", root)
    juris = with_srid(
        shape_table(spark, [("PLACE", "Franklin", rectangle(1820000, 710000, 1830000, 720000))],
                    ("PLACECOMBO", STRING), ("COUNTY", STRING)), 3735,
    )
    jobs.build_region(spark, juris, root)
    jobs.build_region(spark, juris, root)
    rows = jobs.read_region(spark, root)
    stored = spark.read.parquet(f"{root}/region")
    assert table(rows, *sorted(stored.columns)) == table(stored, *sorted(stored.columns))
    got = table(rows, "COUNTY", "OBJECTID", "YRBUILT", "TYPE", "UNITS", "APPRTOT", "PLACECOMBO")
    assert got == [
        ("franklin", "u", 1999.0, "SF-A", 4, None, "PLACE"),
        ("pickaway", "a", 1970.0, "SF-SL", 1, 20.0, "PLACE"),
    ]
    out = jobs.summaries(rows, juris)
    assert table(out["units_by_county_year"], "COUNTY", "UNITS") == [("franklin", 4), ("pickaway", 1)]
    assert out["density_map"].count() == 1
    assert out["density_map_jurisdictions"].count() == 1
    assert table(out["density_histogram"], "bin", "n") == [(0, 1)]
    assert out["parcels_by_county_year"].count() == 0
    assert out["type_map"].count() == 0


def test_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == named.rstrip("/")
    df = session.durable(spark.range(5), "t")
    assert df.count() == 5 and named in df.inputFiles()[0]

    def fake(master):
        context = SimpleNamespace(applicationId=f"app-{master}")
        return SimpleNamespace(conf={"spark.master": master}, sparkContext=context)

    with pytest.raises(ValueError):
        session.shared_dir(fake("yarn"))
    own = session.shared_dir(fake("local[2]"))
    assert own == session.shared_dir(fake("local[2]")) != session.shared_dir(fake("local[3]"))


def test_morrow_tables(spark):
    building = spark.createDataFrame(
        [("p", "401", "3", "1", "1990"), ("p", "401", "3", "2", "1990"), ("q", "510", "1", "1", "1"),
         ("r", None, "1", "1", "1")],
        "PropertyNumber string, UseCode string, UnitCount string, CardNumber string, YearBuilt string",
    )
    assert table(counties.apartment_buildings(building), "*") == [("p", "401", 3.0)]
    assert [tuple(r) for r in counties.cards_per_property(building).collect()] == [
        ("p", 2), ("q", 1), ("r", 1),
    ]
    lots = parcels(spark, [(1, "p", "2.5", A)], "Name", "A_Acreage")
    out = counties.morrow(lots, building, building)
    assert table(out, "property", "acres", "land_use", "year_built", "county") == [
        ("p", "2.5", "401", "1990", "Morrow")
    ] * 4
