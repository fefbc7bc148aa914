"""One query per operator or job, each over whole tables.

Coordinates are shown in thousandths of a foot or finer. They are shifted by a third
of a step before rounding, so that no value sits on a rounding tie where two engines
may part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import inputs as I
from catalog import sources as S
from lotwise import configure
from lotwise.functions import geometry as G
from lotwise.functions import values as V
from lotwise.functions.once import with_computed
from lotwise.functions.projection import (
    EQUAL_AREA,
    GEOGRAPHIC,
    OHIO_SOUTH,
    SQ_FEET_PER_ACRE,
    to_srid,
)
from lotwise.operators import cards as C
from lotwise.operators import collapse as D
from lotwise.operators import dissolve as M
from lotwise.operators import overlay
from lotwise.operators import joins as J
from lotwise.operators import profile, spatial
from lotwise.plans import counties, files, jobs, region, summary
from lotwise.schema import srid_of, to_parcel_schema, with_srid
from lotwise.session import durable, new_folder
from lotwise.sources import archives, collection, geojson, layers, listing, service, sinks, tables

Query = Callable[[SparkSession, str], DataFrame]


def feet(v: Column) -> Column:
    return F.round(v + 0.00037, 3)


def lower(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def measured(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Geometry replaced by area and centroid, which an oracle can state."""
    return (
        with_computed(df, _c=G.centroid(geometry))
        .withColumn("area", F.round(G.area(geometry), 2))
        .withColumn("cx", feet(F.col("_c.x")))
        .withColumn("cy", feet(F.col("_c.y")))
        .drop("_c", geometry)
    )


# --- joins and counts -----------------------------------------------------------


def units_per_parcel(spark, sf_dir):
    return spatial.count_points(
        I.parcels(spark, sf_dir), I.addresses(spark, sf_dir), "row_id", "lsn", "units"
    )


def units_mixed_shapes(spark, sf_dir):
    """Lots, holed blocks of many sizes and zones of twenty parts, in one join."""
    shapes = I.mixed_shapes(spark, sf_dir)
    return spatial.count_points(shapes, I.addresses(spark, sf_dir), "id", "lsn", "units")


def address_parcel_pairs(spark, sf_dir):
    parcels = I.parcels(spark, sf_dir).select("row_id", "geometry")
    pairs = spatial.points_in_polygons(I.addresses(spark, sf_dir), parcels)
    return pairs.select("row_id", "addr_id", "lsn")


def units_across_systems(spark, sf_dir):
    """Addresses in degrees against parcels in feet. Points are moved off the places
    where one could sit exactly on a lot line, which no round trip would keep."""
    points = I.addresses(spark, sf_dir)
    points = with_computed(points, point=G.point(F.col("point.x") + 0.123, "point.y"))
    degrees = to_srid(points, "NAD83", "point")
    return spatial.count_points(I.parcels(spark, sf_dir), degrees, "row_id", "lsn", "units")


def units_left_join(spark, sf_dir):
    parcels = I.parcels(spark, sf_dir)
    units = spatial.count_points(parcels, I.addresses(spark, sf_dir), "parcelid", "lsn", "units")
    return J.left_join(parcels.select("row_id", "parcelid"), units, "parcelid")


def jurisdiction_of_parcel(spark, sf_dir):
    parcels = I.parcels(spark, sf_dir)
    points = with_computed(parcels.select("row_id", "geometry"), centroid=G.centroid("geometry"))
    points = with_srid(points.drop("geometry"), OHIO_SOUTH, "centroid")
    out = spatial.assign_region(points, I.jurisdictions(spark, sf_dir), "PLACECOMBO")
    return lower(out.drop("centroid"))


def jurisdiction_subset(spark, sf_dir):
    return lower(
        summary.region_jurisdictions(I.jurisdictions(spark, sf_dir)).drop("geometry")
    )


# --- duplicates -------------------------------------------------------------------


def _numbered(spark, sf_dir):
    return I.parcels(spark, sf_dir).withColumn("yrbuilt", V.to_number("yrbuilt"))


def dedupe_geometry(spark, sf_dir):
    df = D.collapse(
        _numbered(spark, sf_dir), ["geometry"], ["parcelid", "class"], ["yrbuilt", "aprbldg"]
    )
    return measured(df)


def dedupe_parcel_id(spark, sf_dir):
    df = D.collapse(
        _numbered(spark, sf_dir), ["parcelid"], ["class", "geometry"], ["yrbuilt", "aprbldg"]
    )
    return measured(df)


def dedupe_id_geometry(spark, sf_dir):
    df = D.collapse(
        _numbered(spark, sf_dir), ["parcelid", "geometry"], ["class"], ["yrbuilt", "aprbldg"]
    )
    return measured(df)


def distinct_but_key(spark, sf_dir):
    df = I.parcels(spark, sf_dir).select("row_id", "class", "county", "yrhist", "geometry")
    return measured(D.distinct_rows(df, "row_id"))


# --- values -----------------------------------------------------------------------


def _acres(spark, sf_dir):
    return I.parcels(spark, sf_dir).withColumn("acres", G.area("geometry") / SQ_FEET_PER_ACRE)


def housing_type(spark, sf_dir):
    return _acres(spark, sf_dir).select(
        "row_id", V.housing_type("acres", "class").alias("type"), F.round("acres", 6).alias("acres")
    )


def single_family_units(spark, sf_dir):
    lots = I.parcels(spark, sf_dir)
    units = spatial.count_points(lots, I.addresses(spark, sf_dir), "row_id", "lsn")
    df = J.left_join(_acres(spark, sf_dir), units, "row_id")
    df = df.withColumn("TYPE", V.housing_type("acres", "class"))
    return lower(region.one_unit_per_house(df).select("row_id", "TYPE", "UNITS"))


def drop_non_parcels(spark, sf_dir):
    df = I.parcels(spark, sf_dir).withColumn("parcelid", V.with_suffix("parcelid", "-00"))
    kept = df.where(~V.has_prefix("parcelid", counties.FRANKLIN.drop_prefixes))
    return kept.select("row_id", "parcelid")


def year_from_history(spark, sf_dir):
    return I.parcels(spark, sf_dir).select("row_id", V.last_part("yrhist").alias("yrbuilt"))


def numeric_clean(spark, sf_dir):
    return I.parcels(spark, sf_dir).select(
        "row_id",
        V.to_number("yrbuilt").alias("year_number"),
        V.to_number_strict(F.col("aprbldg").cast("string")).alias("value_number"),
        V.to_integer_strict(F.col("row_id").cast("string")).alias("id_number"),
        V.id_text("parcelid").alias("id_text"),
    )


def keep_null_filter(spark, sf_dir):
    df = I.parcels(spark, sf_dir)
    kept = df.where(
        V.differs("class", " ") & F.col("yrhist").isNotNull() & (F.col("county") != "knox")
    )
    return kept.select("row_id", "class", "yrhist")


def complete_rows(spark, sf_dir):
    df = I.parcels(spark, sf_dir).select("row_id", "class", "yrbuilt", "aprland")
    return df.dropna(how="any")


def id_digits(spark, sf_dir):
    customer = I.table(spark, sf_dir, "customer")
    return customer.select(
        "c_custkey",
        V.digits_only("c_name").alias("digits"),
        V.first_digits("c_name").alias("number"),
        V.to_text("c_nationkey").alias("nation"),
        V.title_case("c_mktsegment").alias("segment"),
        V.joined_text("/", "c_name", V.to_text("c_nationkey")).alias("path"),
        V.base_name(V.joined_text("/", "c_mktsegment", "c_name")).alias("base"),
        V.folder_name(V.joined_text("/", "c_mktsegment", "c_name")).alias("folder"),
        V.extension(F.concat("c_name", F.lit(".zip"))).alias("ext"),
        V.replace_value("c_mktsegment", "BUILDING", "").alias("replaced"),
        V.first_item(F.split("c_name", "#")).alias("word"),
    )


def fallback_year(spark, sf_dir):
    return I.dwelling(spark, sf_dir).select(
        "parcel_id", "card", V.fallback("yreff", "yrblt").alias("year")
    )


# --- cards ------------------------------------------------------------------------


def _number_cards(spark, sf_dir):
    cards = C.all_cards(
        I.dwelling(spark, sf_dir).select("parcel_id", "card", "yrblt"),
        I.building(spark, sf_dir).select("parcel_id", "card", "yrblt"),
    )
    return cards.withColumn("yrblt", V.to_number("yrblt"))


def cama_max_year(spark, sf_dir):
    return C.latest_year(_number_cards(spark, sf_dir), "parcel_id", "yrblt", "yrbuilt")


def _text_cards(spark, sf_dir):
    columns = ["parcel_id", "card", "yrblt", "yreff"]
    return C.all_cards(
        I.building(spark, sf_dir).select(*columns), I.dwelling(spark, sf_dir).select(*columns)
    )


def cama_text_max_year(spark, sf_dir):
    cards = _text_cards(spark, sf_dir)
    return C.latest_effective_year(cards, "parcel_id", "yrblt", "yreff", "yrbuilt")


def cama_many_join(spark, sf_dir):
    parcels = I.parcels(spark, sf_dir).select("parcelid", "class", "county")
    rights = [
        C.latest_year(_number_cards(spark, sf_dir), "parcel_id", "yrblt", "yrbuilt"),
        C.latest_effective_year(_text_cards(spark, sf_dir), "parcel_id", "yrblt", "yreff", "yreff"),
    ]
    rights = [r.withColumnRenamed("parcel_id", "parcelid") for r in rights]
    return D.distinct_rows(J.left_join_many(parcels, rights, "parcelid"), "parcelid")


def cama_inner_complete(spark, sf_dir):
    parcels = I.parcels(spark, sf_dir).select("parcelid", "class", "aprland")
    joined = J.inner_complete(I.dwelling(spark, sf_dir), parcels, "parcel_id", "parcelid")
    return joined.withColumn("county", F.lit("Morrow"))


def cards_per_parcel(spark, sf_dir):
    return C.rows_per_key(I.dwelling(spark, sf_dir), "parcel_id", "yrblt", "n_cards")


# --- geometry ---------------------------------------------------------------------


def parcel_area_acres(spark, sf_dir):
    return _acres(spark, sf_dir).select("row_id", F.round("acres", 6).alias("acres"))


def centroids(spark, sf_dir):
    df = I.parcels(spark, sf_dir).select("row_id", "geometry")
    df = with_computed(df, centroid=G.centroid("geometry"), _box=G.bounding_box("geometry"))
    box = F.col("_box")
    return df.select(
        "row_id",
        feet(G.x_of("centroid")).alias("cx"),
        feet(G.y_of("centroid")).alias("cy"),
        G.covers("geometry", "centroid.x", "centroid.y").alias("inside"),
        G.is_valid_shape("geometry").alias("valid"),
        *[box[c].alias(c) for c in ("xmin", "ymin", "xmax", "ymax")],
    )


def reproject(spark, sf_dir):
    """Every lot corner in degrees and back, and on the equal-area plane."""
    feet_table = I.parcels(spark, sf_dir).select("row_id", "geometry")
    degrees = to_srid(feet_table, "NAD83")
    back = to_srid(degrees, "epsg:3735").select("row_id", F.col("geometry").alias("g_back"))
    metres = to_srid(degrees, "epsg:9822").select("row_id", F.col("geometry").alias("g_metres"))
    assert srid_of(degrees) == GEOGRAPHIC and srid_of(metres, "g_metres") == EQUAL_AREA
    joined = degrees.join(back, "row_id").join(metres, "row_id")

    def corner(g: str) -> Column:
        return F.col(g)[0][0]

    corners = joined.select(
        "row_id",
        F.posexplode(F.arrays_zip(*[corner(g).alias(g) for g in ("geometry", "g_back", "g_metres")])),
    )
    return corners.select(
        "row_id",
        F.col("pos").alias("corner"),
        F.round("col.geometry.x", 9).alias("lon"),
        F.round("col.geometry.y", 9).alias("lat"),
        feet(F.col("col.g_back.x")).alias("x_back"),
        feet(F.col("col.g_back.y")).alias("y_back"),
        F.round("col.g_metres.x", 4).alias("x_metres"),
        F.round("col.g_metres.y", 4).alias("y_metres"),
    )


def dissolve_jurisdictions(spark, sf_dir):
    outlines = summary.county_outlines(I.jurisdictions(spark, sf_dir))
    return outlines.select(
        F.col("COUNTY").alias("county"),
        F.round(G.area("geometry"), 2).alias("area"),
        F.size("geometry").alias("parts"),
        feet(G.centroid("geometry")["x"]).alias("cx"),
        feet(G.centroid("geometry")["y"]).alias("cy"),
    )


def dissolve_border_area(spark, sf_dir):
    edges = M.border_edges(I.jurisdictions(spark, sf_dir), "COUNTY")
    lengths = edges.groupBy("COUNTY").agg(F.count(F.lit(1)).alias("n_edges"))
    return lower(
        M.border_area(edges, "COUNTY").join(lengths, "COUNTY").withColumn(
            "area", F.round("area", 2)
        )
    )


def dissolve_parcels(spark, sf_dir):
    parcels = I.parcels(spark, sf_dir)
    unique = D.collapse(parcels, ["geometry"], ["parcelid", "class"], keep_order=True)
    merged = M.dissolve(unique, "parcelid", first=["class"])
    return merged.select(
        "parcelid",
        "class",
        F.round(G.area("geometry"), 2).alias("area"),
        F.size("geometry").alias("parts"),
    )


def dissolve_tjunctions(spark, sf_dir):
    """Lots in three pieces whose shared borders have a corner on one side only."""
    pieces = I.lot_pieces(spark, sf_dir)
    return M.dissolve(pieces, "row_id", order="piece").select(
        "row_id",
        F.round(G.area("geometry"), 2).alias("area"),
        F.size("geometry").alias("parts"),
    )


def dissolve_repeats(spark, sf_dir):
    """Each lot twice under its id: its ring turned, and from another corner."""
    return M.dissolve(I.turned_lots(spark, sf_dir), "row_id", order="turn").select(
        "row_id",
        F.round(G.area("geometry"), 2).alias("area"),
        F.size("geometry").alias("parts"),
    )


def dissolve_overlaps(spark, sf_dir):
    """Lots whose pieces overlap, touch or lie apart: union area, parts and flag."""
    merged = overlay.dissolve_exact(I.overlapping_lots(spark, sf_dir), "row_id")
    return merged.select(
        "row_id", F.round(G.area("geometry"), 2).alias("area"), F.size("geometry").alias("parts"), "overlaps"
    )


def covered_area(spark, sf_dir):
    """The same area without tracing rings, against what the pieces sum up to."""
    lots = I.overlapping_lots(spark, sf_dir)
    sums = lots.groupBy("row_id").agg(F.round(F.sum(G.area("geometry")), 2).alias("summed"))
    covered = overlay.covered_area(lots, "row_id").withColumn("area", F.round("area", 2))
    return covered.join(sums, "row_id")


def dissolve_many_parts(spark, sf_dir):
    """All lots of a county as one shape of many parts, and the addresses in it."""
    lots = D.collapse(
        I.parcels(spark, sf_dir), ["geometry"], ["parcelid", "county"], keep_order=True
    )
    merged = durable(M.dissolve(lots, "county"), "merged")
    merged = with_srid(merged, srid_of(lots, "geometry"))
    units = spatial.count_points(merged, I.addresses(spark, sf_dir), "county", "lsn", "units")
    return merged.join(units, "county", "left").select(
        "county",
        F.round(G.area("geometry"), 2).alias("area"),
        F.size("geometry").alias("parts"),
        "units",
    )


# --- region and summaries ---------------------------------------------------------


def standard_parcels(spark, sf_dir):
    """All parcels in the standard columns, units counted by id."""
    lots = I.parcels(spark, sf_dir)
    units = spatial.count_points(lots, I.addresses(spark, sf_dir), "parcelid", "lsn")
    df = J.left_join(lots, units, "parcelid")
    return df.select(
        F.col("parcelid").alias("OBJECTID"),
        F.col("class").alias("CLASS"),
        F.col("yrbuilt").alias("YRBUILT"),
        (F.col("aprland") + F.col("aprbldg")).alias("APPRTOT"),
        "UNITS",
        "geometry",
        F.col("county").alias("COUNTY"),
        "row_id",
    )


def region_rows(spark, sf_dir):
    return region.region_table(standard_parcels(spark, sf_dir), I.jurisdictions(spark, sf_dir))


def mapped_rows(spark, sf_dir):
    """Rows of the density map, written: what follows reads them more than once."""
    rows = summary.choropleth_rows(summary.analysis(region_rows(spark, sf_dir)))
    return durable(rows.select("COUNTY", "UNITS_PER_ACRE"), "mapped")


def region_union(spark, sf_dir):
    """All counties but one have acres: two tables by name, one scan for each."""
    lots = S.lots(spark, sf_dir).select(
        F.col("parcelid").alias("OBJECTID"),
        F.col("class").alias("CLASS"),
        "acres",
        "row_id",
        F.col("county").alias("COUNTY"),
    )
    without = F.col("COUNTY") == "fairfield"
    return lower(tables.union_tables([lots.where(~without), lots.where(without).drop("acres")]))


def region_table(spark, sf_dir):
    return lower(
        region_rows(spark, sf_dir)
        .withColumn("CALCACRES", F.round("CALCACRES", 6))
        .withColumn("APPRTOT", F.round("APPRTOT", 2))
        .withColumn("x", feet(F.col("x")))
        .withColumn("y", feet(F.col("y")))
        .drop("geometry")
    )


def density(spark, sf_dir):
    df = summary.analysis(region_rows(spark, sf_dir))
    return lower(
        df.select(
            "row_id",
            F.round("UNITS_PER_ACRE", 5).alias("UNITS_PER_ACRE"),
            F.round("VALPERACRE", 1).alias("VALPERACRE"),
        )
    )


def units_by_county_year(spark, sf_dir):
    return lower(summary.units_by_county_year(region_rows(spark, sf_dir)))


def units_by_type_year(spark, sf_dir):
    return lower(summary.units_by_type_year(region_rows(spark, sf_dir)))


# The years that the test tables hold from 2010 on; the SQL names them one by one.
YEARS = list(range(2010, 2025))


def parcels_by_county_year_pivot(spark, sf_dir):
    """One column for each year that the rows hold, however many."""
    rows = durable(region_rows(spark, sf_dir).select("COUNTY", "YRBUILT", "geometry"), "region")
    wide = summary.parcels_by_county_year(rows, None)
    return wide.toDF("county", *[f"y{y}" for y in wide.columns[1:]])


def type_map_rows(spark, sf_dir):
    rows = summary.type_map_rows(region_rows(spark, sf_dir))
    return lower(rows.withColumn("x", feet(F.col("x"))).withColumn("y", feet(F.col("y"))))


def choropleth_rows(spark, sf_dir):
    rows = summary.choropleth_rows(summary.analysis(region_rows(spark, sf_dir)))
    return lower(
        rows.select("row_id", "TYPE", F.round("UNITS_PER_ACRE", 5).alias("UNITS_PER_ACRE"))
    )


def choropleth_jurisdictions(spark, sf_dir):
    rows = mapped_rows(spark, sf_dir)
    out = summary.choropleth_jurisdictions(I.jurisdictions(spark, sf_dir), rows)
    return lower(out.drop("geometry"))


def units_per_acre_histogram(spark, sf_dir):
    out = summary.density_histogram(mapped_rows(spark, sf_dir))
    return out.withColumn("bin_start", F.round("bin_start", 5))


def summary_from_files(spark, sf_dir):
    """Counties written, region built from their folders, summed from its GeoJSON."""
    root = new_folder(spark, "region")
    standard = to_parcel_schema(standard_parcels(spark, sf_dir), "COUNTY")
    sinks.write_counties(standard, f"{root}/counties")
    jobs.build_region(spark, I.jurisdictions(spark, sf_dir), root)
    return lower(summary.units_by_county_year(jobs.read_region(spark, root)))


# --- profile ----------------------------------------------------------------------


def _profile(name: str) -> Query:
    def query(spark, sf_dir):
        I.configure(spark)
        return profile.column_profile(I.table(spark, sf_dir, name))

    return query


def column_samples(spark, sf_dir):
    return profile.column_samples(I.table(spark, sf_dir, "lineitem"))


# --- sources and sinks ------------------------------------------------------------


# Fixed value: how a link reads in a page.
LINK = 'href="([^"]*)"'


def listing_links(spark, sf_dir):
    I.configure(spark)
    pages = I.table(spark, sf_dir, "pages")
    return pages.select(
        "page_id",
        F.size(listing.links("html", LINK)).alias("n_links"),
        listing.last_link("html", LINK).alias("last_link"),
        listing.last_link("html", LINK, "a").alias("last_with_a"),
    )


def page_plan(spark, sf_dir):
    """Pages of a service per county, from the texts of its replies."""
    counts = I.parcels(spark, sf_dir).groupBy("county").agg(F.count(F.lit(1)).alias("n"))
    description = F.struct(
        F.lit(50).alias("maxRecordCount"),
        F.struct(F.struct(F.lit(OHIO_SOUTH).alias("latestWkid")).alias("spatialReference")).alias(
            "extent"
        ),
        F.array(
            F.struct(F.lit("id").alias("name")), F.struct(F.col("county").alias("name"))
        ).alias("fields"),
    )
    replies = counts.select(
        "county",
        F.to_json(F.struct(F.col("n").alias("count"))).alias("reply"),
        service.service_metadata(F.to_json(description)).alias("meta"),
    )
    offsets = service.page_offsets(service.record_count("reply"), F.col("meta.page_size"))
    return replies.select(
        "county",
        F.col("meta.srid").alias("srid"),
        V.joined_text(",", F.col("meta.fields")).alias("fields"),
        F.explode(offsets).alias("offset"),
    )


PAGE = 1000


def _paged(df: DataFrame, number: str, feature: Column) -> DataFrame:
    """(offset, body): features grouped into pages by running number."""
    offset = (F.floor(F.col(number) / PAGE) * PAGE).cast("bigint")
    pages = df.select(offset.alias("offset"), feature.alias("f")).groupBy("offset")
    body = F.to_json(F.struct(F.collect_list("f").alias("features")))
    return pages.agg(body.alias("body"))


def service_pages(spark, sf_dir):
    """Addresses landed as pages of a feature service and read back through the scan."""
    df = I.addresses(spark, sf_dir)
    geometry = F.struct(
        F.lit("Point").alias("type"), F.array("point.x", "point.y").alias("coordinates")
    )
    properties = F.struct(F.col("addr_id").alias("ID"), F.col("lsn").alias("LSN"))
    feature = F.struct(properties.alias("properties"), geometry.alias("geometry"))
    root = new_folder(spark, "service")
    pages = _paged(df, "addr_id", feature)
    pages.write.partitionBy("offset").text(f"{root}/pages")
    last = df.agg(F.max("addr_id").alias("n"))
    last.select(F.to_json(F.struct((F.col("n") + 1).alias("count")))).write.text(f"{root}/count")
    meta = (
        f'{{"maxRecordCount": {PAGE}, "extent": {{"spatialReference": {{"latestWkid": 3735}}}}, '
        '"fields": [{"name": "ID"}, {"name": "LSN"}]}'
    )
    spark.range(1).select(F.lit(meta)).write.text(f"{root}/meta")
    back = service.read_service(
        spark, root, "ID:bigint,LSN:bigint", kind="point", columns=["ID", "LSN"]
    )
    assert srid_of(back, "point") == OHIO_SOUTH
    return back.select(
        F.col("ID").alias("addr_id"), F.col("LSN").alias("lsn"), "point.x", "point.y"
    )


def esri_pages(spark, sf_dir):
    """Parcels and addresses as Esri JSON pages: rings and x, y."""
    parcels = I.parcels(spark, sf_dir)
    rings = F.transform(
        F.col("geometry")[0],
        lambda r: F.transform(F.reverse(r), lambda p: F.array(p["x"], p["y"])),
    )
    attributes = F.struct(F.col("row_id").alias("ID"))
    polygon = F.struct(
        attributes.alias("attributes"), F.struct(rings.alias("rings")).alias("geometry")
    )
    shapes = service.esri_polygons(_paged(parcels, "row_id", polygon), "ID:bigint")
    located = F.struct(
        F.struct(F.col("addr_id").alias("ID")).alias("attributes"), F.col("point").alias("geometry")
    )
    points = service.esri_points(
        _paged(I.addresses(spark, sf_dir), "addr_id", located), "ID:bigint"
    )
    out = shapes.select(
        F.lit("polygon").alias("kind"),
        F.col("ID").alias("id"),
        F.round(G.area("geometry"), 2).alias("area"),
        G.bounding_box("geometry")["xmin"].alias("x"),
        G.bounding_box("geometry")["ymin"].alias("y"),
    )
    return out.unionByName(
        points.where(G.is_valid_point("point")).select(
            F.lit("point").alias("kind"),
            F.col("ID").alias("id"),
            F.lit(None).cast("double").alias("area"),
            "point.x",
            "point.y",
        )
    )


def _zipped_cards(spark, sf_dir):
    """One archive per batch of cards: one table as pipe text, comma text, XML and sheet."""

    def zipped(batches):
        import io
        import zipfile
        from xml.sax.saxutils import quoteattr

        import pandas as pd

        for batch in batches:
            plain = batch.astype(object).where(batch.notna(), None)
            space = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
            cells = [[f'<c r="{c}1" t="inlineStr"><is><t>{n}</t></is></c>'
                      for c, n in zip("ABC", batch.columns)]]
            for r, row in enumerate(plain.itertuples(index=False), 2):
                cells.append(
                    [f'<c r="{c}{r}"><v>{v}</v></c>' for c, v in zip("ABC", row) if v is not None]
                )
            rows = "".join(f"<row>{''.join(row)}</row>" for row in cells)
            book = io.BytesIO()
            with zipfile.ZipFile(book, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr(
                    "xl/worksheets/sheet1.xml",
                    f'<worksheet xmlns="{space}"><sheetData>{rows}</sheetData></worksheet>',
                )
            records = "".join(
                "<Card "
                + " ".join(f"{k}={quoteattr(str(v))}" for k, v in row.items() if v is not None)
                + "/>"
                for row in plain.to_dict("records")
            )
            held = io.BytesIO()
            with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr("folder/", "")
                z.writestr("_index.txt", "skip")
                z.writestr("cards.txt", batch.to_csv(sep="|", index=False))
                z.writestr("tables/cards.csv", batch.to_csv(index=False))
                z.writestr("cards.xml", f"<Cards>{records}</Cards>")
                z.writestr("cards.xlsx", book.getvalue())
            yield pd.DataFrame({"path": ["cards.zip"], "content": [held.getvalue()]})

    cards = I.dwelling(spark, sf_dir).select("parcel_id", "card", "yrblt")
    return durable(cards.mapInPandas(zipped, "path string, content binary"), "zips")


def archive_tables(spark, sf_dir):
    """Cards zipped by the tasks, read back from four kinds of entries."""
    zips = _zipped_cards(spark, sf_dir)
    columns = ["parcel_id", "card", "yrblt"]
    out = None
    for entry in ("cards.txt", "tables/cards.csv", "cards.xml", "cards.xlsx"):
        kind = entry.rsplit(".", 1)[-1]
        table = archives.read_entry(zips, entry, columns).select(
            F.lit(kind).alias("kind"), *columns
        )
        out = table if out is None else out.unionByName(table)
    return out.groupBy("kind", *columns).agg(F.count(F.lit(1)).alias("n"))


def archive_entries(spark, sf_dir):
    """Entries of the archives; folders and underscore entries are left out."""
    entries = archives.list_entries(_zipped_cards(spark, sf_dir))
    return entries.select("entry", "name", "extension").distinct()


def text_tables(spark, sf_dir):
    """Cards as pipe text, comma text and XML attribute records, written and read back."""
    cards = I.building(spark, sf_dir).selectExpr(
        "parcel_id", "cast(card as string) as card", "yrblt", "yreff"
    )
    root = new_folder(spark, "text")
    cards.write.csv(f"{root}/pipe", sep="|", header=True)
    cards.write.csv(f"{root}/comma", header=True)
    attributes = cards.toDF(*[f"_{c}" for c in cards.columns])
    attributes.write.format("xml").option("rowTag", "Card").option("rootTag", "Cards").save(
        f"{root}/xml"
    )
    columns = ["parcel_id", "card", "yrblt", "yreff"]
    read = {
        "pipe": tables.read_delimited(spark, f"{root}/pipe", "|", columns),
        "comma": tables.read_delimited(spark, f"{root}/comma", ",", columns),
        "xml": tables.read_xml_records(spark, f"{root}/xml", "Card", columns),
    }
    out = None
    for kind, table in read.items():
        tagged = table.withColumn("kind", F.lit(kind))
        out = tagged if out is None else out.unionByName(tagged)
    return out.groupBy("kind", *columns).agg(F.count(F.lit(1)).alias("n"))


def geojson_roundtrip(spark, sf_dir):
    parcels = I.parcels(spark, sf_dir).select("row_id", "parcelid", "class", "geometry")
    path = new_folder(spark, "geojson")
    geojson.write_geojson(parcels, path)
    back = geojson.read_geojson_lines(spark, path, "row_id:bigint,parcelid:string,class:string")
    return measured(back)


def geojson_collection(spark, sf_dir):
    """Parcels written as one FeatureCollection file and read in several tasks, at blocks
    of 64 KB; the reference system comes back with them."""
    parcels = I.parcels(spark, sf_dir).select("row_id", "parcelid", "class", "geometry")
    path = new_folder(spark, "collection")
    collection.write_collection(parcels.coalesce(1), path)
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        back = collection.read_collection(spark, path, "row_id:bigint,parcelid:string,class:string")
        rows = durable(back, "features")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    assert srid_of(back) == OHIO_SOUTH
    return measured(rows)


def quoted_line_breaks(spark, sf_dir):
    """Whole texts, line breaks and all, written as comma files with quotes and read in
    several tasks, at blocks of 64 KB."""
    texts = I.table(configure(spark), sf_dir, "documents").select("doc_id", "lang", "text")
    path = new_folder(spark, "quoted")
    texts.write.csv(
        path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        rows = durable(tables.read_delimited(spark, path), "quoted")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)
    return rows.select("doc_id", "lang", F.md5("text").alias("text_md5"), F.length("text").alias("n_chars"))


# Corners of the window that is read, in feet.
WINDOW = (1804000.0, 700250.0, 1809090.0, 702000.0)


def layer_window(spark, sf_dir):
    """Parcels written as a layer in Z-order, and those whose bounds meet a window."""
    path = new_folder(spark, "layer")
    layers.write_layer(I.parcels(spark, sf_dir).select("row_id", "class", "geometry"), path, files=32)
    rows = layers.read_window(spark, path, WINDOW)
    assert srid_of(rows) == OHIO_SOUTH
    return measured(rows)


def table_write_append(spark, sf_dir):
    """Raw copy, county folders written twice (same result), rows appended once more."""
    lots = I.parcels(spark, sf_dir).withColumnRenamed("county", "COUNTY")
    root = new_folder(spark, "tables")
    sinks.write_raw(lots, f"{root}/raw")
    raw = tables.read_layer(spark, f"{root}/raw", ["row_id", "parcelid", "COUNTY"])
    sinks.write_counties(raw, f"{root}/counties")
    sinks.write_counties(raw.where(F.col("COUNTY") == "union"), f"{root}/counties")
    sinks.append_rows(raw.select("row_id", "parcelid"), f"{root}/points")
    sinks.append_rows(raw.select("row_id", "parcelid"), f"{root}/points")
    for _ in range(2):  # the second time nothing is added
        sinks.append_rows(raw.select("row_id"), f"{root}/batches", batch="2024-01")
    sinks.append_rows(raw.select("row_id").limit(0), f"{root}/batches", batch="2024-02")
    assert spark.read.parquet(f"{root}/batches").count() == raw.count()
    some = tables.read_counties(spark, f"{root}/counties", ["franklin", "union"])
    twice = spark.read.parquet(f"{root}/points")
    return (
        some.select("row_id", "parcelid", F.col("COUNTY").cast("string").alias("county"))
        .unionByName(twice.withColumn("county", F.lit("appended")))
        .groupBy("row_id", "parcelid", "county")
        .agg(F.count(F.lit(1)).alias("n"))
    )


# --- counties ---------------------------------------------------------------------


def _standard(name: str, address_id: str = "LSN") -> Query:
    def query(spark, sf_dir):
        county = counties.STANDARD[name]
        cards = S.franklin_cards(spark, sf_dir) if county.year_from_cards else None
        df = counties.standard_table(
            county,
            getattr(S, name)(spark, sf_dir),
            S.addresses(spark, sf_dir, address_id),
            cards,
        )
        return lower(measured(df))

    return query


def county_madison(spark, sf_dir):
    df = counties.madison(
        S.madison(spark, sf_dir),
        S.addresses(spark, sf_dir),
        S.madison_cards(I.building(spark, sf_dir)),
        S.madison_cards(I.dwelling(spark, sf_dir)),
        S.madison_appraisal(spark, sf_dir),
        S.madison_parcel_table(spark, sf_dir),
    )
    return lower(measured(df))


def county_knox(spark, sf_dir):
    df = counties.knox(
        S.knox(spark, sf_dir),
        S.addresses(spark, sf_dir, "GlobalID"),
        S.knox_extract(spark, sf_dir),
        S.knox_cards(I.building(spark, sf_dir)),
        S.knox_cards(I.dwelling(spark, sf_dir)),
    )
    return lower(
        df.drop("geometry").withColumn("x", feet(F.col("x"))).withColumn("y", feet(F.col("y")))
    )


def county_logan(spark, sf_dir):
    df = counties.logan(
        S.logan(spark, sf_dir),
        S.addresses(spark, sf_dir),
        S.logan_cards(I.building(spark, sf_dir)),
        S.logan_cards(I.dwelling(spark, sf_dir)),
    )
    return lower(
        df.drop("geometry").withColumn("x", feet(F.col("x"))).withColumn("y", feet(F.col("y")))
    )


def county_morrow(spark, sf_dir):
    df = counties.morrow(
        S.morrow(spark, sf_dir),
        S.morrow_cards(I.building(spark, sf_dir)),
        S.morrow_cards(I.dwelling(spark, sf_dir)),
    )
    return measured(df)


def _from_files(spark, name: str, layers_of: dict, texts: dict, write) -> str:
    """A county's files written, and its table built from them; the second run must find
    nothing to do. Returns where the tables are."""
    root = new_folder(spark, name)
    raw = f"{root}/raw"
    for table, df in layers_of.items():
        sinks.write_raw(df, f"{raw}/{name}/{table}")
    for table, df in texts.items():
        write(df, f"{raw}/{name}/{table}")
    assert files.build_changed(spark, raw, root, [name]) == [name]
    assert files.build_changed(spark, raw, root, [name]) == []
    return root


def _pipe_text(df: DataFrame, path: str) -> None:
    df.write.csv(
        path, sep="|", header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )


def _records(df: DataFrame, path: str) -> None:
    attributes = df.toDF(*[f"_{c}" for c in df.columns])
    attributes.write.format("xml").option("rowTag", "Card").option("rootTag", "Cards").save(path)


def county_madison_from_files(spark, sf_dir):
    """The standard table, from layers and four XML tables. Land uses are trimmed, as the
    XML reader does."""
    root = _from_files(
        spark,
        "madison",
        {"parcels": S.madison(spark, sf_dir), "addresses": S.addresses(spark, sf_dir)},
        {
            "building": S.madison_cards(I.building(spark, sf_dir)),
            "dwelling": S.madison_cards(I.dwelling(spark, sf_dir)),
            "appraisal": S.madison_appraisal(spark, sf_dir).withColumn(
                "Land_Use_Code", F.expr("nullif(trim(Land_Use_Code), '')")
            ),
            "parcel_table": S.madison_parcel_table(spark, sf_dir),
        },
        _records,
    )
    return lower(measured(jobs.county_tables(spark, root, ["madison"]).drop("COUNTY")))


def county_knox_from_files(spark, sf_dir):
    """Housing-type points, from layers and three tables of pipe text."""
    root = _from_files(
        spark,
        "knox",
        {"parcels": S.knox(spark, sf_dir), "addresses": S.addresses(spark, sf_dir, "GlobalID")},
        {
            "extract": S.knox_extract(spark, sf_dir),
            "building": S.knox_cards(I.building(spark, sf_dir)),
            "dwelling": S.knox_cards(I.dwelling(spark, sf_dir)),
        },
        _pipe_text,
    )
    df = lower(spark.read.parquet(f"{root}/points").where("batch = 'knox'").drop("batch"))
    return df.withColumn("x", feet(F.col("x"))).withColumn("y", feet(F.col("y")))


def county_morrow_from_files(spark, sf_dir):
    """Cards with their parcels, from a layer and two tables of pipe text."""
    root = _from_files(
        spark,
        "morrow",
        {"parcels": S.morrow(spark, sf_dir)},
        {
            "building": S.morrow_cards(I.building(spark, sf_dir)),
            "dwelling": S.morrow_cards(I.dwelling(spark, sf_dir)),
        },
        _pipe_text,
    )
    return measured(spark.read.parquet(f"{root}/cards/morrow"))


def apartment_buildings(spark, sf_dir):
    return lower(counties.apartment_buildings(S.morrow_cards(I.building(spark, sf_dir))))


def cards_per_property(spark, sf_dir):
    return lower(counties.cards_per_property(S.morrow_cards(I.dwelling(spark, sf_dir))))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        units_per_parcel,
        units_mixed_shapes,
        address_parcel_pairs,
        units_across_systems,
        units_left_join,
        jurisdiction_of_parcel,
        jurisdiction_subset,
        dedupe_geometry,
        dedupe_parcel_id,
        dedupe_id_geometry,
        distinct_but_key,
        housing_type,
        single_family_units,
        drop_non_parcels,
        year_from_history,
        numeric_clean,
        keep_null_filter,
        complete_rows,
        id_digits,
        fallback_year,
        cama_max_year,
        cama_text_max_year,
        cama_many_join,
        cama_inner_complete,
        cards_per_parcel,
        parcel_area_acres,
        centroids,
        reproject,
        dissolve_jurisdictions,
        dissolve_border_area,
        dissolve_parcels,
        dissolve_tjunctions,
        dissolve_repeats,
        dissolve_overlaps,
        covered_area,
        dissolve_many_parts,
        region_union,
        region_table,
        density,
        units_by_county_year,
        units_by_type_year,
        parcels_by_county_year_pivot,
        type_map_rows,
        choropleth_rows,
        choropleth_jurisdictions,
        units_per_acre_histogram,
        summary_from_files,
        column_samples,
        listing_links,
        page_plan,
        service_pages,
        esri_pages,
        archive_tables,
        archive_entries,
        text_tables,
        geojson_roundtrip,
        geojson_collection,
        quoted_line_breaks,
        layer_window,
        table_write_append,
        county_madison,
        county_knox,
        county_logan,
        county_morrow,
        county_madison_from_files,
        county_knox_from_files,
        county_morrow_from_files,
        apartment_buildings,
        cards_per_property,
    )
}
QUERIES["column_profile"] = _profile("lineitem")
QUERIES["column_profile_documents"] = _profile("documents")
for _name, _county in counties.STANDARD.items():
    QUERIES[f"county_{_name}"] = _standard(_name, _county.address_id)
