"""Tables behind the regional analysis and its plots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.functions import values as V
from lotwise.operators.dissolve import dissolve
from lotwise.operators.joins import keep_named_in
from lotwise.operators.summaries import count_by_year_wide, histogram, units_by, with_densities
from lotwise.plans.region import COUNTIES

# First years of the summaries and of the maps; the county mapped.
SINCE_UNITS = 1965
SINCE_COUNTS = 2010
SINCE_MAP = 2020
MAPPED_COUNTY = "franklin"


def analysis(region: DataFrame) -> DataFrame:
    return with_densities(region)


def units_by_county_year(region: DataFrame) -> DataFrame:
    return units_by(region, ["COUNTY", "YRBUILT"], SINCE_UNITS)


def units_by_type_year(region: DataFrame) -> DataFrame:
    """Also the rows of the yearly line plot: types that are known."""
    return units_by(region, ["TYPE", "YRBUILT"], SINCE_UNITS).where(V.differs("TYPE", "nan"))


def parcels_by_county_year(region: DataFrame, years: list[int] | None = None) -> DataFrame:
    return count_by_year_wide(region, "COUNTY", SINCE_COUNTS, years)


def region_jurisdictions(jurisdictions: DataFrame) -> DataFrame:
    """Jurisdictions of the region's counties."""
    return jurisdictions.where(F.col("COUNTY").isin(*[c.title() for c in COUNTIES]))


def county_outlines(jurisdictions: DataFrame) -> DataFrame:
    """One shape per county, merged from its jurisdictions."""
    return dissolve(jurisdictions, "COUNTY", order="juris_id")


def type_map_rows(region: DataFrame) -> DataFrame:
    """Points of the housing-type map."""
    recent = (F.col("YRBUILT") >= SINCE_MAP) & V.differs("TYPE", "nan")
    return region.where(recent).select("x", "y", "UNITS", "TYPE")


def choropleth_rows(analysed: DataFrame) -> DataFrame:
    """Parcels of the density map."""
    return analysed.where(
        F.col("UNITS_PER_ACRE").isNotNull()
        & (F.col("COUNTY") == MAPPED_COUNTY)
        & V.differs("TYPE", "nan")
    )


def choropleth_jurisdictions(jurisdictions: DataFrame, rows: DataFrame) -> DataFrame:
    """Jurisdictions of the counties that the density map shows."""
    return keep_named_in(jurisdictions, "COUNTY", rows.select("COUNTY").distinct(), "COUNTY")


def density_histogram(rows: DataFrame, bins: int = 30) -> DataFrame:
    return histogram(rows, "UNITS_PER_ACRE", bins)
