"""The jobs end to end, from files to files.

Layout under one root: ``counties/COUNTY=<name>/`` (standard tables), ``region/`` (the
regional table, parquet) and ``region_geojson/`` (the same as GeoJSON lines).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.functions.projection import OHIO_SOUTH
from lotwise.plans import counties, region, summary
from lotwise.schema import to_parcel_schema, with_srid
from lotwise.sources import geojson, sinks, tables

# Properties of the regional table that the GeoJSON file carries.
REGION_FIELDS = (
    "OBJECTID:string,CLASS:string,YRBUILT:double,ACRES:double,APPRTOT:double,UNITS:bigint,"
    "COUNTY:string,CALCACRES:double,TYPE:string,x:double,y:double,PLACECOMBO:string"
)


def save_county(table: DataFrame, name: str, root: str) -> None:
    """Write one county's table in the standard columns; other counties stay as they are."""
    standard = to_parcel_schema(table).withColumn("COUNTY", F.lit(name))
    sinks.write_counties(standard, f"{root}/counties")


def build_county(
    name: str,
    parcels: DataFrame,
    addresses: DataFrame,
    root: str,
    cards: DataFrame | None = None,
) -> None:
    """Raw parcels and addresses of one of the standard counties to its table."""
    table = counties.standard_table(counties.STANDARD[name], parcels, addresses, cards)
    save_county(table, name, root)


def county_tables(spark: SparkSession, root: str, names: list[str] | None = None) -> DataFrame:
    df = tables.read_counties(spark, f"{root}/counties", names)
    return with_srid(df.withColumn("COUNTY", F.col("COUNTY").cast("string")), OHIO_SOUTH)


def build_region(spark: SparkSession, jurisdictions: DataFrame, root: str) -> None:
    """County tables to the regional table, as parquet and as GeoJSON lines.

    The parquet copy is computed once; the GeoJSON copy reads it.
    """
    df = region.region_table(county_tables(spark, root, list(region.COUNTIES)), jurisdictions)
    df.write.mode("overwrite").parquet(f"{root}/region")
    stored = spark.read.parquet(f"{root}/region")
    geojson.write_geojson(stored, f"{root}/region_geojson", "overwrite")


def read_region(spark: SparkSession, root: str) -> DataFrame:
    """The regional table from its GeoJSON lines."""
    df = geojson.read_geojson_lines(spark, f"{root}/region_geojson", REGION_FIELDS)
    return with_srid(df, OHIO_SOUTH)


def summaries(region_rows: DataFrame, jurisdictions: DataFrame) -> dict[str, DataFrame]:
    """All tables of the analysis by name, each computed when it is used."""
    analysed = summary.analysis(region_rows)
    mapped = summary.choropleth_rows(analysed)
    return {
        "analysis": analysed,
        "units_by_county_year": summary.units_by_county_year(region_rows),
        "units_by_type_year": summary.units_by_type_year(region_rows),
        "parcels_by_county_year": summary.parcels_by_county_year(region_rows),
        "type_map": summary.type_map_rows(region_rows),
        "density_map": mapped,
        "density_map_jurisdictions": summary.choropleth_jurisdictions(jurisdictions, mapped),
        "density_histogram": summary.density_histogram(mapped),
        "region_jurisdictions": summary.region_jurisdictions(jurisdictions),
    }
